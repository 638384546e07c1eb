"""Sinks: partitioned landing copies, overwrite tables, idempotent event append, text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from foghorn.functions import text as tx
from foghorn.plans.events import EVENT_KEY, union_events
from foghorn.sources import event_table
from foghorn.sources.readers import exists, read_events


def land_raw(df: DataFrame, folder: str, by: Sequence[str] = ("country", "industry")) -> None:
    """Immutable landing copy, one directory per slugged key combination."""
    slugged = df.withColumns({f"{c}_dir": tx.slug_path(c) for c in by})
    slugged.write.mode("append").partitionBy(*[f"{c}_dir" for c in by]).parquet(folder)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def append_plain(df: DataFrame, path: str) -> None:
    """Append without de-duplication."""
    df.write.mode("append").parquet(path)


def write_lines(df: DataFrame, path: str) -> None:
    """One text line per row of a single-column frame."""
    df.write.mode("overwrite").text(path)


def append_events(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    source: str = "",
    signal_type: str = "",
    key: Sequence[str] = EVENT_KEY,
) -> int:
    """Idempotent append to an event table; returns how many rows it grew by.

    Only the months that the rows touch are written anew, see ``event_table``.
    """
    return event_table.append(spark, path, incoming, source, signal_type, key)


def append_many(spark: SparkSession, path: str, frames: Sequence[DataFrame]) -> int:
    frames = [f for f in frames if f is not None]
    if not frames:
        return 0
    return append_events(spark, path, union_events(frames, strength=0.0))


def append_new_only(spark: SparkSession, path: str, incoming: DataFrame, key: str = "url") -> DataFrame:
    """Rows whose key the table does not hold yet."""
    if not exists(spark, path):
        return incoming
    seen = read_events(spark, path) if event_table.latest(spark, path) else spark.read.parquet(path)
    seen = seen.select(F.col(key)).distinct()
    return incoming.join(seen, key, "left_anti")
