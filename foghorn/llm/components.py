"""Connected components of an edge table, and spanning edges of sorted candidate groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from foghorn.session import materialise


def connected_components(
    edges: DataFrame, a: str = "a", b: str = "b", keep: Callable[[DataFrame], DataFrame] = materialise
) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected to, for every node of ``edges``.

    Distributed union-find by alternating stars: in a large-star round every node ties its larger
    neighbours to the smallest node it knows, in a small-star round it ties its smaller ones. Each
    round is an aggregation (combined before the shuffle) and a join, the edge count never grows
    beyond that of the input, and the number of rounds grows with the logarithm of the longest path.
    ``keep`` writes a round to the shared folder and reads it back; only counts and sums come to the driver. Null and self edges are
    ignored; an empty table gives no rows. Nodes are any ordered type.
    """

    def directed(frame: DataFrame) -> DataFrame:
        return frame.filter(F.col("a") != F.col("b")).select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        )

    def state(frame: DataFrame) -> tuple:
        return frame.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()[:]

    current = keep(directed(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))).distinct())
    before = state(current)
    while before[0]:
        # large star: larger neighbours of each node, and the node's smallest neighbour
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("m", "a").alias("m"))
        larger = both.filter("b > a").join(least, "a")
        stars = larger.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        stars = keep(stars)
        # small star: smaller neighbours of each node meet at the smallest of them
        low = stars.groupBy("a").agg(F.min("b").alias("m"))
        tied = stars.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = directed(tied.unionByName(low.select("a", F.col("m").alias("b")))).distinct()
        current = keep(after)
        now = state(current)
        if now == before:
            break
        before = now
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values of a sorted array."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return starts, np.diff(np.append(starts, len(keys)))


def whole_groups(batches: Iterator) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns of sorted rows as arrays, cut only between groups of the first, an integer column.

    A task holds one batch and the group that its last row belongs to; the caller bounds the groups.
    """
    held: list[np.ndarray] = []
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held:
            columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
        if not len(columns[0]):
            continue
        last = int(np.searchsorted(columns[0], columns[0][-1], side="left"))
        if last:
            yield tuple(c[:last] for c in columns)
        held = [c[last:] for c in columns]
    if held and len(held[0]):
        yield tuple(held)
