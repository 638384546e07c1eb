"""Exact quantiles whose working set is bounded whatever the skew."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from foghorn.operators.rows import _null_safe_join
from foghorn.session import materialise


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: Mapping[str, float]
) -> DataFrame:
    """Linear-interpolated quantiles per group, as NumPy defines them.

    ``percentile`` keeps every distinct value of a group in one task's buffer.
    Here equal values are first counted together, the (group, value) pairs are
    range-partitioned, and only the ranges that hold a wanted rank are looked
    at, each bounded by its range. Nulls in ``value`` are ignored.

    ``probs`` maps output column to probability. Groups are ``by``; an empty
    ``by`` gives one row.
    """
    keys = list(by)
    if not keys:
        df = df.withColumn("_all", F.lit(1))
        keys = ["_all"]
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranged = counts.repartitionByRange(*keys, "_v")
    ranged = materialise(ranged.withColumn("_part", F.spark_partition_id()))

    # one row per (range, group): how many rows came before it, and the group total
    sizes = ranged.groupBy("_part", *keys).agg(F.sum("_n").alias("_size"))
    earlier = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    spans = sizes.select(
        "_part",
        *keys,
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
        "_size",
        F.sum("_size").over(W.partitionBy(*keys)).alias("_total"),
    )
    # wanted zero-based ranks per group, kept on the ranges that contain them
    ranks = F.array(
        *[
            F.struct(F.lit(name).alias("name"), position.alias("rank"), weight.alias("weight"))
            for name, p in probs.items()
            for position, weight in _ranks(p)
        ]
    )
    wanted = (
        spans.withColumn("_want", F.explode(ranks))
        .filter(
            (F.col("_want.rank") >= F.col("_before"))
            & (F.col("_want.rank") < F.col("_before") + F.col("_size"))
        )
        .groupBy("_part", *keys, "_before")
        .agg(F.collect_list("_want").alias("_wants"))
    )
    inside = W.partitionBy("_part", *keys).orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    located = (
        _null_safe_join(ranged, wanted, ["_part", *keys])
        .withColumn("_upto", F.col("_before") + F.sum("_n").over(inside))
        .withColumn("_want", F.explode("_wants"))
        .filter(
            (F.col("_want.rank") < F.col("_upto"))
            & (F.col("_want.rank") >= F.col("_upto") - F.col("_n"))
        )
    )
    parts = [
        F.sum(
            F.when(F.col("_want.name") == name, F.col("_v") * F.col("_want.weight"))
        ).alias(name)
        for name in probs
    ]
    result = located.groupBy(*keys).agg(*parts)
    return result.drop("_all")


def _ranks(p: float):
    """The two neighbouring ranks of probability ``p`` and their weights."""
    position = F.lit(float(p)) * (F.col("_total") - 1)
    low = F.floor(position)
    high = F.ceil(position)
    frac = position - low
    yield low.cast("bigint"), F.lit(1.0) - frac
    yield high.cast("bigint"), frac


def small_domain_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: Mapping[str, float]
) -> DataFrame:
    """Quantiles of a column with a bounded domain (rounded scores, small counts).

    Equal values are counted together before the shuffle, so the percentile
    buffer holds at most the domain.
    """
    keys = list(by)
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(
        *[F.percentile(F.col(value), F.lit(p), F.col("_n")).alias(n) for n, p in probs.items()]
    )


def winsorise(
    df: DataFrame, value: str, p: float = 0.95, by: Sequence[str] = (), out: str | None = None
) -> DataFrame:
    """Clip the upper tail at the exact ``p`` quantile, globally or per group."""
    out = out or value
    highs = exact_quantiles(df, by, value, {"_high": p})
    if by:
        joined = _null_safe_left(df, highs, list(by))
    else:
        joined = df.withColumn("_high", highs.scalar())
    clipped = F.when(F.col(value) > F.col("_high"), F.col("_high")).otherwise(F.col(value))
    return joined.withColumn(out, clipped).drop("_high")


def _null_safe_left(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = right
    condition = F.lit(True)
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"_r_{key}")
        condition = condition & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    return left.join(renamed, condition, "left").drop(*[f"_r_{key}" for key in keys])
