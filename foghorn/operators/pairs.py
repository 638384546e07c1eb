"""Co-occurrence of a bounded vocabulary, and the graph measures on top of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def pair_counts(df: DataFrame, terms: str) -> DataFrame:
    """Unordered pair counts ``(a, b, weight)`` with ``a < b`` over sorted term arrays.

    Items with the same term set are counted together before anything is
    expanded, so the expansion grows with the number of distinct sets and not
    with the number of items.
    """
    sets = (
        df.select(F.array_sort(F.array_distinct(terms)).alias("_terms"))
        .filter(F.size("_terms") >= 2)
        .groupBy("_terms")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    pairs = F.flatten(
        F.transform(
            "_terms",
            lambda a, i: F.transform(
                F.slice("_terms", i + 2, F.size("_terms")),
                lambda b: F.struct(a.alias("a"), b.alias("b")),
            ),
        )
    )
    return (
        sets.select(F.explode(pairs).alias("_pair"), "_n")
        .groupBy(F.col("_pair.a").alias("a"), F.col("_pair.b").alias("b"))
        .agg(F.sum("_n").alias("weight"))
    )


def dense_matrix(edges: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Symmetric matrix with a row and a column for every listed term, zeros filled."""
    spark = edges.sparkSession
    both = edges.select("a", "b", "weight").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight")
    )
    cells = both.groupBy("a").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("b") == t, F.col("weight"))), F.lit(0)).alias(t)
            for t in terms
        ]
    )
    rows = spark.createDataFrame([(t,) for t in terms], "a string")
    return rows.join(cells, "a", "left").fillna(0)


def node_degrees(edges: DataFrame) -> DataFrame:
    """Degree and weighted degree of every node that has an edge."""
    ends = edges.select(F.col("a").alias("node"), "weight").unionByName(
        edges.select(F.col("b").alias("node"), "weight")
    )
    return ends.groupBy("node").agg(
        F.count(F.lit(1)).alias("degree"), F.sum("weight").alias("strength")
    )
