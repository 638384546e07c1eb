"""Whole-table column profile and frequency tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from foghorn.operators.rows import top_k


def column_profile(
    df: DataFrame, columns: Sequence[str], exact: bool = True, samples: int = 3
) -> DataFrame:
    """Type, non-null count, null share, distinct count, extremes and sample values.

    Extremes are compared in the column's own type and only then rendered as text;
    the samples are the first values in text order. Exact distinct counts are taken
    over (column, value) pairs that are grouped before they are counted, so no
    task sees all the values of one column; ``exact=False`` uses the sketch.
    """
    types = dict(df.dtypes)
    pairs = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                    for c in columns
                ]
            )
        ).alias("_cell")
    ).select("_cell.column", "_cell.value")
    if exact:
        values = pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    else:
        values = pairs.withColumn("n", F.lit(1))
    distinct = (
        F.count("value") if exact else F.approx_count_distinct("value")
    )
    stats = values.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("non_null"),
        distinct.alias("distinct_values"),
    )
    ends = df.agg(*[f(c).cast("string").alias(f"{k}_{i}") for i, c in enumerate(columns) for k, f in (("a", F.min), ("z", F.max))])
    ends = ends.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(f"a_{i}").alias("smallest"), F.col(f"z_{i}").alias("largest"))
                    for i, c in enumerate(columns)
                ]
            )
        ).alias("_end")
    ).select("_end.*")
    shown = top_k(values.filter("value IS NOT NULL").select("column", "value").distinct(), ["column"], [F.col("value")], samples)
    shown = shown.groupBy("column").agg(F.array_join(F.sort_array(F.collect_list("value")), " | ").alias("samples"))
    stats = stats.join(ends, "column").join(shown, "column", "left")
    type_of = F.create_map(*[F.lit(x) for c in columns for x in (c, types[c])])
    return stats.select(
        "column",
        F.try_element_at(type_of, F.col("column")).alias("data_type"),
        F.col("rows").cast("bigint").alias("rows"),
        F.col("non_null").cast("bigint").alias("non_null"),
        F.round(100.0 * (F.col("rows") - F.col("non_null")) / F.col("rows"), 2).alias("null_pct"),
        F.col("distinct_values").cast("bigint").alias("distinct_values"),
        "smallest",
        "largest",
        "samples",
    )


def value_frequency(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def token_frequency(df: DataFrame, column: str, pattern: str = r"[^\p{L}\p{N}]+") -> DataFrame:
    """Counts of lower-case tokens, blank tokens dropped."""
    tokens = df.select(F.explode(F.split(F.lower(F.col(column)), pattern)).alias("token"))
    return tokens.filter("token <> ''").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
