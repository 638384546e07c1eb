"""Centroid clustering of integer vectors by scalar lookup tables.

Components are scaled and floored to integers once. Vectors are written in blocks: for every dimension
the integer values that occur in the block, and for every vector the place of its value among them.
A round tabulates, for each dimension, occurring value and centroid, the squared difference; the
distance of a vector to all centroids is then a sum of table rows gathered by its places. What leaves a
task is one sum per centroid and dimension, whatever the number of vectors; the driver gets their
totals, k * (dimensions + 1) integers a round, and divides them. All arithmetic is in integers, so
neither the order of the rows nor their distribution over tasks changes the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from foghorn.llm.common import Shipped, stored
from foghorn.session import spread

#: Vectors of a block; a place among the values of a dimension fits 16 bits.
BLOCK = 4096
#: Integers beyond this count as this, so that 64 squared differences fit a long.
LARGEST = 1 << 27


@dataclass(frozen=True)
class Settings:
    clusters: int = 8
    dimensions: int = 64
    rounds: int = 10
    scale: int = 1024
    salt: str = "3"


def integer_vectors(vectors: DataFrame, settings: Settings, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id`` and ``x``, the integers, of the vectors that have all their components."""
    given = F.col(vector_col)
    odd = F.exists(given, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    bound = float(LARGEST)
    whole = F.transform(
        given.cast("array<double>"),
        lambda x: F.floor(F.greatest(F.lit(-bound), F.least(F.lit(bound), x * float(settings.scale)))).cast("int"),
    )
    kept = vectors.filter(given.isNotNull() & (F.size(given) == settings.dimensions)).filter(~odd)
    return kept.select(F.col(id_col).cast("bigint").alias("vec_id"), whole.alias("x"))


class Block:
    """Vectors as places among the values that occur in each dimension."""

    def __init__(self, occurring: bytes, counts: bytes, places: bytes):
        self.occurring = np.frombuffer(occurring, np.int32).astype(np.int64)
        self.counts = np.frombuffer(counts, np.int32)
        self.starts = np.cumsum(self.counts) - self.counts
        self.places = np.frombuffer(places, np.uint16).reshape(len(self.counts), -1)

    @staticmethod
    def encode(x: np.ndarray) -> tuple[bytes, bytes, bytes]:
        """``x`` holds a vector per row."""
        values, places = zip(*(np.unique(column, return_inverse=True) for column in x.T), strict=True)
        counts = np.array([len(v) for v in values], np.int32)
        joined = np.concatenate(values).astype(np.int32)
        return joined.tobytes(), counts.tobytes(), np.stack(places).astype(np.uint16).tobytes()

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid, the smaller of equally near ones, and the squared distance."""
        table = self.occurring[:, None] - np.repeat(centroids.T, self.counts, axis=0)
        table *= table
        total = np.zeros((self.places.shape[1], len(centroids)), np.int64)
        for start, count, place in zip(self.starts, self.counts, self.places, strict=True):
            total += table[start : start + count].take(place, axis=0)
        cluster = total.argmin(axis=1)
        return cluster, total[np.arange(len(total)), cluster]

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """For each centroid and dimension the sum of its vectors' components."""
        out = np.zeros((k, len(self.counts)), np.int64)
        for d, (start, place) in enumerate(zip(self.starts, self.places, strict=True)):
            np.add.at(out[:, d], cluster, self.occurring[start + place.astype(np.int64)])
        return out


def blocks(vectors: DataFrame, size: int = BLOCK) -> DataFrame:
    """The vectors in blocks of at most ``size``, those of one partition together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            x = rows.column(1).combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
            ids = pa.array([rows.column(0).to_pylist()], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays(
                [ids, *(pa.array([b], pa.binary()) for b in Block.encode(x))],
                ["ids", "occurring", "counts", "places"],
            )

        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            while rows >= size:
                table = pa.Table.from_batches(held)
                yield block(table.slice(0, size))
                held = table.slice(size).to_batches()
                rows -= size
        if rows:
            yield block(pa.Table.from_batches(held))

    return vectors.mapInArrow(run, "ids array<bigint>, occurring binary, counts binary, places binary")


def totals(coded: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each cluster the vectors' number, distances and components, summed; a row per task and sum is shuffled."""
    shipped = Shipped(coded.sparkSession, centroids)
    k, dimensions = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.get()
        sums = np.zeros((k, dimensions + 2), np.int64)
        for batch in batches:
            for parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block = Block(*parts)
                cluster, distance = block.nearest(own)
                np.add.at(sums[:, 0], cluster, 1)
                np.add.at(sums[:, 1], cluster, distance)
                sums[:, 2:] += block.sums(cluster, k)
        if sums[:, 0].any():
            at = np.indices(sums.shape).reshape(2, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[0]), pa.array(at[1]), pa.array(sums.ravel())], ["cluster", "at", "total"]
            )

    parts = coded.select("occurring", "counts", "places").mapInArrow(run, "cluster bigint, at bigint, total bigint")
    out = np.zeros((k, dimensions + 2), np.int64)
    found = parts.groupBy("cluster", "at").agg(F.sum("total").alias("total")).toArrow()
    out[found.column("cluster").to_numpy(), found.column("at").to_numpy()] = found.column("total").to_numpy()
    return out[:, 0], out[:, 1], out[:, 2:]


def first_centroids(vectors: DataFrame, settings: Settings) -> np.ndarray:
    """The vectors whose salted id has the smallest digests: a distributed take-ordered of ``clusters`` rows."""
    digest = F.sha2(F.concat(F.lit(f"{settings.salt}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = vectors.orderBy(digest.asc_nulls_last(), "x").limit(settings.clusters).select("x").collect()
    return np.array([r[0] for r in first], np.int64).reshape(len(first), settings.dimensions)


def _choose(values: list, cluster: Column) -> Column:
    kind = "string" if isinstance(values[0], str) else "bigint"
    return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), cluster + 1)


def cluster_vectors(
    vectors: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    A vector that is null, has another number of components, or a null, NaN or infinite one is left
    out. A component x counts as floor(scale * x), at most 2^27 either way. Every round assigns each
    vector to the nearest centroid (the smaller number of equally near ones) and moves a centroid to
    the floored mean of its vectors; one without vectors stays. Vectors with a null id take part, but
    are among the first centroids only where too few others are; of equal ids the smaller vector comes
    first. Repeated rows count each time. With fewer vectors than clusters there are as many centroids
    as vectors; an empty table gives no rows. Other columns are dropped, whatever their names.
    """
    rows = integer_vectors(spread(vectors), settings, id_col, vector_col)
    centroids = first_centroids(rows, settings)
    schema = "vec_id bigint, cluster int, distance bigint"
    if not len(centroids):
        out = rows.sparkSession.createDataFrame([], schema)
        return out.select(
            "*",
            *(F.lit(0).cast("bigint").alias(c) for c in ("cluster_inertia", "inertia")),
            F.lit("").alias("centroid_sha256"),
        )
    coded = stored(blocks(rows))
    for _ in range(settings.rounds):
        count, _, sums = totals(coded, centroids)
        moved = [s // n if n else c for s, n, c in zip(sums, count, centroids, strict=True)]
        centroids = np.array(moved, np.int64)
    _, inertia, _ = totals(coded, centroids)
    inertia = [int(x) for x in inertia]
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    shipped = Shipped(coded.sparkSession, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.get()
        for batch in batches:
            for ids, *parts in zip(*batch.columns, strict=True):
                cluster, distance = Block(*(p.as_py() for p in parts)).nearest(own)
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(cluster.astype(np.int32)), pa.array(distance)],
                    ["vec_id", "cluster", "distance"],
                )

    cluster = F.col("cluster")
    return coded.mapInArrow(run, schema).select(
        "vec_id",
        "cluster",
        "distance",
        _choose(inertia, cluster).alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("bigint").alias("inertia"),
        _choose(digests, cluster).alias("centroid_sha256"),
    )


def clusters_sql(settings: Settings = Settings()) -> str:
    """DuckDB's statement for the table ``embeddings``: every round a pair of common table expressions."""
    k, n = settings.clusters, settings.dimensions

    def near(at: int) -> str:  # distance and number in one integer, so that the least is the nearest
        distance = "list_sum(list_transform(range(1, {n} + 1), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))"
        return f"""a{at} AS MATERIALIZED (
  SELECT v.row_no, min({distance.format(n=n)}::BIGINT * {k} + c.k) AS best FROM v, c{at} c GROUP BY v.row_no)"""

    def move(at: int) -> str:
        return f"""c{at + 1} AS MATERIALIZED (
  WITH s AS (
    SELECT best % {k} AS k, i, sum(v.x[i])::BIGINT AS s, count(*) AS n
    FROM a{at} JOIN v USING (row_no), range(1, {n} + 1) r(i) GROUP BY ALL
  ), m AS (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM s GROUP BY k)
  SELECT c.k, coalesce(m.x, c.x) AS x FROM c{at} c LEFT JOIN m USING (k))"""

    steps = [part for at in range(settings.rounds) for part in (near(at), move(at))] + [near(settings.rounds)]
    joined = ",\n".join(steps)
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS row_no,
         list_transform(embedding, lambda x: floor({settings.scale} * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE len(embedding) = {n} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {n}
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{settings.salt}:' || vec_id), x) - 1 AS k, x FROM v
  ORDER BY k LIMIT {k}
), {joined},
d AS (SELECT row_no, (best % {k})::INTEGER AS cluster, best // {k} AS distance FROM a{settings.rounds})
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM d JOIN v USING (row_no) JOIN c{settings.rounds} c ON c.k = cluster"""
