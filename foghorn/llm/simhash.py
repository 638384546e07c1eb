"""Near duplicates by SimHash fingerprints, pigeonhole blocks and verified Hamming distance.

The 64 bits are split into ``blocks`` blocks. Two fingerprints that differ in at most d bits agree
on at least blocks - d of them, so they share the key made of some choice of blocks - d blocks.
Distinct fingerprints are joined on these keys by a shuffle, and each meeting is verified. More
blocks make longer keys, hence fewer accidental meetings, and more keys per fingerprint: the number
of blocks follows from the number of fingerprints and changes the cost only, never the result.

The members of a key are compared in the task that has it, and only links that connect something
new leave the task: at most one fewer than the members, never all pairs. A key with more members
than ``CELL`` is split into parts, and each pair of parts is a cell of its own, so a hot key is
spread over many tasks and no task holds more than two parts at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from foghorn.llm.common import map_batches, text_of
from foghorn.llm.components import connected_components, runs, whole_groups
from foghorn.session import materialise

SHINGLE = 4
DISTANCE = 4
SEED = 42
CELL = 1024
#: Runs up to this length are compared all at once by shifting, longer ones by search.
SHIFTED = 12


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is 1 if it is set in more than half of the hashes of all word shingles."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    begins = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    stops = ends[len(words) - n :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[i:j], seed) for i, j in zip(begins, stops, strict=True)], "<u8")
    set_bits = np.zeros(64, np.int64)
    for at in range(0, n, 65536):  # bounds the unpacked bits of a very long text
        bits = np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_bits * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, keyed: bool = False
) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long, one row per row of ``docs``.

    With ``keyed`` also ``sha`` and ``row``, the digest of the text and the hash of all columns.
    """
    names = ["doc_id", "fp", *(["sha", "row"] if keyed else [])]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        marks = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
        marks = np.array(marks, np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks), *batch.columns[2:]], names)

    rows = docs.select(
        F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"), *(_row_key(docs, text_col) if keyed else [])
    )
    return map_batches(rows, run, "doc_id bigint, fp bigint" + (", sha string, row bigint" if keyed else ""))


def _row_key(docs: DataFrame, text_col: str) -> list[Column]:
    """``sha`` and ``row``: with the id they tell rows apart, equal copies aside."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return [F.sha2(text_of(text_col).cast("binary"), 256).alias("sha"), F.xxhash64(whole).alias("row")]


def block_count(distinct: int, distance: int) -> int:
    """Blocks for which keys are long enough that accidental meetings stay near one per key."""
    for blocks in range(distance + 1, 17):
        if 64 * (blocks - distance) / blocks >= np.log2(max(distinct, 2)) + 2:
            return blocks
    return 16


def block_keys(blocks: int, distance: int) -> list[tuple[int, int]]:
    """(number, mask) of each choice of blocks that a close pair may share."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - (1 << edges[i])) for i in range(blocks)]
    chosen = combinations(range(blocks), blocks - distance)
    return [(i, sum(masks[k] for k in c)) for i, c in enumerate(chosen)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _meeting_keys(fp: Column, blocks: int, distance: int) -> Column:
    return F.array(
        *[
            F.xxhash64(F.lit(i), fp.bitwiseAND(F.lit(_signed(mask)).cast("bigint")))
            for i, mask in block_keys(blocks, distance)
        ]
    )


def spanning_links(keys: np.ndarray, marks: np.ndarray, sides: np.ndarray, distance: int) -> list[np.ndarray]:
    """Links that connect the close members of each run of equal keys; few more than needed.

    ``sides`` tells the parts of a cell (0 and 1 in a cell of two parts, both to be compared with
    the other only); in an undivided group all are 0.
    """
    starts, sizes = runs(keys)
    out_a, out_b = [], []
    small = sizes <= SHIFTED
    length = np.repeat(sizes, sizes)
    place = np.arange(len(keys)) - np.repeat(starts, sizes)
    for shift in range(1, int(sizes[small].max(initial=1))):
        at = np.flatnonzero((length <= SHIFTED) & (place + shift < length))
        near = np.bitwise_count(marks[at] ^ marks[at + shift]) <= distance
        out_a.append(marks[at[near]])
        out_b.append(marks[at[near] + shift])
    for start, size in zip(starts[~small].tolist(), sizes[~small].tolist(), strict=True):
        members, part = marks[start : start + size], sides[start : start + size]
        two = bool(part.any()) and not part.all()
        open_ = np.ones(size, bool)
        for seed in range(size):
            if not open_[seed]:
                continue
            open_[seed] = False
            stack = [seed]
            while stack:
                i = stack.pop()
                reach = np.flatnonzero(open_ & (part != part[i]) if two else open_)
                near = reach[np.bitwise_count(members[reach] ^ members[i]) <= distance]
                if len(near):
                    open_[near] = False
                    out_a.append(np.full(len(near), members[i]))
                    out_b.append(members[near])
                    stack.extend(near.tolist())
    empty = np.empty(0, np.uint64)
    return [np.concatenate(out_a) if out_a else empty, np.concatenate(out_b) if out_b else empty]


def links(marks: DataFrame, distance: int = DISTANCE, cell: int = CELL) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints (column ``fp``) that connect all close ones."""
    blocks = block_count(marks.count(), distance)
    met = marks.select("fp", F.explode(_meeting_keys(F.col("fp"), blocks, distance)).alias("key"))
    large = met.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell)
    large = materialise(large.withColumn("parts", F.ceil(F.col("n") / (cell // 2)).cast("int")).drop("n"))
    if large.isEmpty():
        dealt = met.withColumn("side", F.lit(0))
    else:
        whole = met.join(large, "key", "left_anti").withColumn("side", F.lit(0))
        # each member of a large key goes to the cells of its part with every part; adaptive
        # execution splits the key's rows in this join, and the cells are dealt out by their own key
        split = met.join(large, "key").withColumn("part", F.pmod(F.xxhash64("fp"), "parts").cast("int"))
        split = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        split = split.select(
            "fp",
            F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("key"),
            (F.col("part") > F.col("other")).cast("int").alias("side"),
        )
        dealt = whole.select("fp", "key", "side").unionByName(split)
    dealt = dealt.select("key", "fp", "side")
    parts = dealt.repartition(F.col("key")).sortWithinPartitions("key", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, fps, sides in whole_groups(batches):
            a, b = spanning_links(keys, fps.view(np.uint64), sides, distance)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]
            )

    return parts.mapInArrow(run, "a bigint, b bigint").distinct()


def rooted(marks: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``marks``, distinct fingerprints ``fp``, with the ``root`` fingerprint of their component."""
    found = connected_components(links(marks.select("fp"), distance))
    roots = found.select(F.col("node").alias("fp"), "root")
    return marks.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (signed long) and component_id.

    Rows are linked if their fingerprints differ in at most ``distance`` bits; the component is named
    by the smallest id that can be reached over links, the row's own included. A text of fewer words
    than a shingle is one shingle; a text without words, or null, has fingerprint zero and is linked
    like any other. Equal fingerprints are one node, so copies cost nothing. A null id takes part but
    never names a component unless all its ids are null. An empty table gives no rows. Other columns
    of the input are dropped, whatever their names.
    """
    rows = materialise(fingerprints(docs, id_col, text_col, shingle))
    marks = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    named = rooted(marks, distance)
    # written, so that the next join shuffles both sides and adaptive execution can split a hot root
    names = materialise(named.groupBy("root").agg(F.min("least").alias("component_id")))
    named = named.join(names, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component of near copies one row of ``docs``, with all its columns.

    It is the row of smallest id, among equal ids that of smallest text digest, then that whose columns
    hash lowest. Rows without an id come last, so one of them stays only if its whole component has
    no id. Every component keeps a row, also where ids repeat with different texts.
    """
    from pyspark.sql import Window

    rows = materialise(fingerprints(docs, id_col, text_col, keyed=True))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "sha", "row")
    marks = materialise(rows.groupBy("fp").agg(F.min(first).alias("first")))
    kept = rooted(marks).groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(*[F.col(f"first.{c}").alias(f"_kept_{c}") for c in ("doc_id", "sha", "row")])
    data = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(id_col).cast("bigint").alias("_id"),
        *[c.alias(f"_{n}") for c, n in zip(_row_key(docs, text_col), ("sha", "hash"), strict=True)],
    )
    same = F.col("_id").eqNullSafe(F.col("_kept_doc_id")) & (F.col("_sha") == F.col("_kept_sha"))
    data = data.join(kept, same & (F.col("_hash") == F.col("_kept_row")), "left_semi")
    order = Window.partitionBy("_id", "_sha", "_hash").orderBy("_hash")  # equal copies of the row kept
    return data.withColumn("_n", F.row_number().over(order)).filter("_n = 1").select("_row.*")
