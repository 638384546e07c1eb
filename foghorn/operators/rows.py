"""Row-selection operators: keep one per key, top-k, distributed row numbers, shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from foghorn.session import materialise


def _cols(items: Sequence[str | Column]) -> list[Column]:
    return [F.col(i) if isinstance(i, str) else i for i in items]


def top_k(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], k: int
) -> DataFrame:
    """First ``k`` rows per key.

    Written as ``row_number() <= k`` so that Catalyst plans a group-limit before
    the shuffle: each task forwards at most ``k`` rows per key, which keeps a
    hot key from ever meeting in one task.
    """
    window = W.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= k).drop("_rn")


def keep_one(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The single first row per key in ``order``; null keys form their own group."""
    return top_k(df, keys, order, 1)


def keep_last(df: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """Last arrival per key; equal arrivals are broken by the whole row's content."""
    rest = [c for c in df.columns if c not in keys and c != arrival]
    return keep_one(df, keys, [F.col(arrival).desc()] + [F.col(c).desc() for c in rest])


def keep_first(df: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c != arrival]
    return keep_one(df, keys, [F.col(arrival).asc()] + [F.col(c).asc() for c in rest])


def row_numbers(
    df: DataFrame,
    order: Sequence[Column],
    out: str = "row_number",
    within: Sequence[str] = (),
) -> DataFrame:
    """Exact 1-based row numbers of any size of input, optionally within groups.

    The rows are range-partitioned and sorted, so no task holds more than its
    range even when one group has most of the rows. Each range learns how many
    rows of its groups sit in earlier ranges from a table with one row per
    (range, group).
    """
    keys = list(within)
    by = [F.col(k).asc() for k in keys] + list(order)
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by)
    ranged = ranged.withColumn("_part", F.spark_partition_id())
    # position inside the range: the low 33 bits of the generated id
    ranged = ranged.withColumn("_pos", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    ranged = materialise(ranged)
    sizes = ranged.groupBy("_part", *keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_start")
    )
    earlier = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    offsets = offsets.drop("_n")
    joined = _null_safe_join(ranged, offsets, ["_part", *keys])
    number = F.col("_before") + F.col("_pos") - F.col("_start") + 1
    return joined.withColumn(out, number.cast("bigint")).drop("_part", "_pos", "_start", "_before")


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which null keys match, keeping the left key columns."""
    renamed = right
    condition = F.lit(True)
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"_r_{key}")
        condition = condition & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    return left.join(renamed, condition).drop(*[f"_r_{key}" for key in keys])


def seeded_head(df: DataFrame, id_col: str, seed: int, n: int = 0) -> DataFrame:
    """Deterministic shuffle by a seeded hash of the id; the first ``n`` rows when asked.

    The order does not depend on partitioning; with ``n`` the plan is a
    distributed take-ordered.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    ordered = df.orderBy(key, F.col(id_col))
    return ordered.limit(n) if n and n > 0 else ordered


def ordered_categories(
    df: DataFrame, value: str, arrival: str, preferred: Sequence[str]
) -> DataFrame:
    """Distinct values, preferred ones first in their order, then by first arrival."""
    rank = F.lit(len(preferred))
    for position, name in reversed(list(enumerate(preferred))):
        rank = F.when(F.col(value) == name, position).otherwise(rank)
    seen = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.min(arrival).alias("first_seen"))
    return seen.withColumn("preferred_rank", rank).orderBy("preferred_rank", "first_seen", value)
