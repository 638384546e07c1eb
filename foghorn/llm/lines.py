"""Fuzzy line deduplication: MinHash over character shingles, verified, one line kept per component.

1. Lines are named by 128 bits of hash; equal lines fall together by an aggregation on the name.
2. One pass over the texts computes MinHash signatures of the distinct lines a task meets and emits
   a key per band. Lines that share a key are candidates: only names travel, never text.
3. The members of a key become a candidate set; sets that several bands agree on are taken once, and
   a key with more than ``CELL`` members is dealt out as cells of two parts, spread over the tasks.
4. A bitmap of fixed size marks the candidates, so that a second pass over the texts emits hardly
   any other line; these texts, one copy of each, join the sets; exact Jaccard similarity is computed
   within a set until its members are connected or compared, and only linking pairs leave the task.
5. Connected components of the links are found by distributed union-find; the earliest line of a
   component is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from foghorn.llm.common import SPACES, Shipped, slices, stored, text_of
from foghorn.llm.components import connected_components, runs, whole_groups
from foghorn.llm.naming import with_group_values
from foghorn.session import materialise

CELL = 256
SLICE_CHARS = 1_000_000
SEEN_LINES = 400_000
#: The seed of Spark's xxhash64, and what it makes of a leading literal "line".
HASH_SEED = 42
SECOND_SEED = xxhash.xxh64_intdigest(b"line", HASH_SEED)
BITMAP_BITS = 1 << 24
BUCKETS = 1024
SKETCH_LINES = 4096


@dataclass(frozen=True)
class Settings:
    """At a similarity of 0.8, twelve bands of four rows miss two links in a thousand, at 0.9 none in 10^5."""

    shingle: int = 6
    bands: int = 12
    rows: int = 4
    similarity: float = 0.8
    seed: int = 5


def shingles(line: str, size: int) -> set[str]:
    """The distinct character shingles; a shorter line is its own only shingle."""
    return {line[i : i + size] for i in range(max(1, len(line) - size + 1))}


def similarity(a: set[str], b: set[str]) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def shingle_hashes(lines: list[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the shingles of all lines, and where each line's begin and how many they are, repeats included."""
    gap = "\n" * size  # no shingle of a line reaches into the next
    text = np.frombuffer((gap.join(lines) + gap).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    starts = np.cumsum(sizes + size) - sizes - size
    n = len(text) - size + 1
    hashes = np.zeros(n, np.uint32)
    for i in range(size):
        hashes = hashes * np.uint32(0x01000193) + text[i : i + n]
    hashes ^= hashes >> np.uint32(15)
    hashes *= np.uint32(0x85EBCA6B)
    hashes ^= hashes >> np.uint32(13)
    return hashes, starts, np.maximum(1, sizes - size + 1)


def sketches(lines: list[str], size: int) -> tuple[list[int], list[int]]:
    """For each line the buckets that its shingles hash to, as bits of a number, and its number of shingles.

    Buckets that only one of two lines has are no more than shingles that only one of them has, so
    the bits in which two sketches differ bound their similarity from above.
    """
    bits, sizes = [], []
    for at in range(0, len(lines), SKETCH_LINES):
        block = lines[at : at + SKETCH_LINES]
        for begin, end in slices(block, SLICE_CHARS):
            hashes, starts, counts = shingle_hashes(block[begin:end], size)
            first = np.cumsum(counts) - counts
            place = np.arange(int(counts.sum())) + np.repeat(starts - first, counts)
            held = np.zeros((end - begin, BUCKETS), bool)
            held[np.repeat(np.arange(end - begin), counts), hashes[place] % np.uint32(BUCKETS)] = True
            bits.extend(int.from_bytes(row.tobytes()) for row in np.packbits(held, axis=1))
            sizes.extend(counts.tolist())
    return bits, sizes


class CodedSets:
    """Distinct shingles of a few lines as sorted integers, equal if and only if the shingles are.

    A character counts as its code point or, where these are too large for a shingle to fit 64 bits, as its
    number among those that occur. If that is too large as well, the shingles themselves are compared.
    """

    def __init__(self, lines: list[str], size: int):
        self.lines, self.size, self.held = lines, size, {}
        gap = "\n" * size
        text = np.frombuffer((gap.join(lines) + gap).encode("utf-32-le"), np.uint32)
        coded, bits = text, int(text.max()).bit_length()
        if bits * size > 64:
            occurs = np.zeros(int(text.max()) + 1, np.uint32)
            occurs[text] = 1
            numbers = np.cumsum(occurs)
            coded, bits = numbers[text], int(numbers[-1]).bit_length()
        self.codes = None
        if bits * size <= 64:
            coded = coded.astype(np.uint64)
            n = len(coded) - size + 1
            self.codes = np.zeros(n, np.uint64)
            for i in range(size):
                self.codes = (self.codes << np.uint64(bits)) | coded[i : i + n]
            lengths = np.fromiter(map(len, lines), np.int64, len(lines))
            self.starts = np.cumsum(lengths + size) - lengths - size

    def get(self, i: int):
        if i not in self.held:
            if self.codes is None:
                self.held[i] = shingles(self.lines[i], self.size)
            else:
                n = max(1, len(self.lines[i]) - self.size + 1)
                codes = np.sort(self.codes[self.starts[i] : self.starts[i] + n])
                self.held[i] = codes[np.concatenate([[True], codes[1:] != codes[:-1]])]
        return self.held[i]

    def similarity(self, i: int, j: int) -> float:
        a, b = self.get(i), self.get(j)
        if self.codes is None:
            return similarity(a, b)
        both = np.concatenate([a, b])
        both.sort()
        shared = int(np.count_nonzero(both[1:] == both[:-1]))
        return shared / (len(both) - shared)


class Signatures:
    """Band keys of many lines at once."""

    def __init__(self, settings: Settings):
        self.settings = settings
        rng = np.random.default_rng(settings.seed)
        n = settings.bands * settings.rows
        self.flip = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        self.scale = rng.integers(0, 1 << 31, n, dtype=np.uint32) * 2 + 1
        self.salt = rng.integers(0, 1 << 63, settings.bands, dtype=np.uint64)

    def keys(self, lines: list[str]) -> np.ndarray:
        """A matrix of lines by bands of 64-bit keys."""
        s = self.settings
        hashes, starts, counts = shingle_hashes(lines, s.shingle)
        order = np.argsort(counts, kind="stable")
        least = np.full((len(lines), len(self.flip)), 0xFFFFFFFF, np.uint32)
        at = 0
        while at < len(order):  # lines of like length, as many as fit the cache, form a matrix
            shortest = int(counts[order[at]])
            end = min(len(order), at + max(1, 65536 // shortest))
            end = at + int(np.searchsorted(counts[order[at:end]], shortest * 1.1 + 4, side="right"))
            rows = order[at:end]
            longest = int(counts[rows[-1]])
            for left in range(0, longest, 65536):
                column = np.arange(left, min(longest, left + 65536))
                block = hashes[starts[rows][:, None] + np.minimum(column, counts[rows][:, None] - 1)]
                held = np.empty_like(block)
                for p in range(len(self.flip)):
                    np.bitwise_xor(block, self.flip[p], out=held)
                    np.multiply(held, self.scale[p], out=held)
                    least[rows, p] = np.minimum(least[rows, p], held.min(axis=1))
            at = end
        parts = least.reshape(len(lines), s.bands, s.rows).astype(np.uint64)
        keys = np.broadcast_to(self.salt, (len(lines), s.bands)).copy()
        for r in range(s.rows):
            keys = (keys ^ parts[:, :, r]) * np.uint64(0x9E3779B97F4A7C15)
            keys ^= keys >> np.uint64(29)
        return keys


def _counts(line: Column) -> Column:
    return line.rlike("[^ \\t-\\r]")


def line_names(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``line_no`` (from 0), ``row`` and the two halves of the name of each line with a character."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.posexplode(F.split(text_of(text_col), "\n")).alias("line_no", "line"),
    )
    rows = rows.filter(_counts(F.col("line")))
    return rows.select(
        "doc_id", "line_no", "row", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2")
    )


def band_keys(docs: DataFrame, text_col: str, settings: Settings) -> DataFrame:
    """``key`` and ``h1`` of every band of the lines, repeated lines once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signatures, seen = Signatures(settings), set()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for begin, end in slices(texts, SLICE_CHARS):
                fresh: dict[int, str] = {}
                for text in texts[begin:end]:
                    for line in text.split("\n"):
                        if line.strip(SPACES):
                            name = xxhash.xxh64_intdigest(line.encode(), HASH_SEED)
                            if name not in seen:
                                fresh.setdefault(name, line)
                seen.update(fresh)
                if len(seen) > SEEN_LINES:
                    seen.clear()
                if fresh:
                    keys = signatures.keys(list(fresh.values()))
                    names = np.fromiter(fresh, np.uint64, len(fresh))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys.ravel().view(np.int64)),
                            pa.array(np.repeat(names, settings.bands).view(np.int64)),
                        ],
                        ["key", "h1"],
                    )

    return docs.select(text_of(text_col).alias("text")).mapInArrow(run, "key bigint, h1 bigint")


def _mixed(values: np.ndarray) -> np.ndarray:
    values = np.ascontiguousarray(values).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values * np.uint64(0xA0761D6478BD642F)


class _Keys:
    """Reads rows sorted by key and name, and gives (set id, name, part) of keys with several names.

    A key of at most ``cell`` names is a set, given whole with part -1 and named by the sum over its
    members, so that equal sets have equal ids. A larger key passes through as it is read, under its
    own id and in parts of half a cell; no more than a batch and a cell are ever held.
    """

    def __init__(self, cell: int):
        self.cell, self.half = cell, cell // 2
        self.held = np.empty((2, 0), np.int64)
        self.large: int | None = None  # the key being passed through, how far, and its last name
        self.passed, self.last = 0, 0

    def read(self, key: np.ndarray, name: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        if self.large is not None:
            own = int(np.searchsorted(key, self.large, side="right"))
            names = name[:own]
            names = names[np.concatenate([names[:1] != self.last, names[1:] != names[:-1]])]
            if len(names):
                yield self._part(names)
            if own == len(key):
                return
            self.large, key, name = None, key[own:], name[own:]
        key, name = np.concatenate([self.held, np.stack([key, name])], axis=1)
        if not len(key):
            return
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (name[1:] != name[:-1])])
        key, name = key[fresh], name[fresh]  # a line met by several tasks counts once
        starts, sizes = runs(key)
        yield self._sets(name, sizes[:-1])
        for i in np.flatnonzero(sizes[:-1] > self.cell).tolist():
            yield from self._begin(key[starts[i]], name[starts[i] : starts[i] + sizes[i]])
        self.large = None
        self.held = np.stack([key[starts[-1] :], name[starts[-1] :]])
        if sizes[-1] > self.cell:
            yield from self._begin(key[-1], self.held[1])
            self.held = np.empty((2, 0), np.int64)

    def close(self) -> tuple[np.ndarray, ...]:
        return self._sets(self.held[1], np.array([self.held.shape[1]]))

    def _sets(self, name: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        small = (sizes > 1) & (sizes <= self.cell)
        name = name[: int(sizes.sum())][np.repeat(small, sizes)]
        if not len(name):
            return tuple(np.empty(0, np.int64) for _ in range(3))
        sizes = sizes[small]
        total = np.add.reduceat(_mixed(name), np.cumsum(sizes) - sizes)
        return np.repeat(total, sizes).view(np.int64), name, np.full(len(name), -1)

    def _begin(self, key: int, names: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        self.large, self.passed = int(key), 0
        yield self._part(names)

    def _part(self, names: np.ndarray) -> tuple[np.ndarray, ...]:
        part = (self.passed + np.arange(len(names))) // self.half
        self.passed, self.last = self.passed + len(names), names[-1]
        return np.full(len(names), self.large), names, part


def candidate_sets(keys: DataFrame, cell: int = CELL) -> DataFrame:
    """``set_id`` and ``h1``: lines to be compared with each other, each distinct set once.

    Every two parts of a key with more than ``cell`` lines make a set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Keys(cell)

        def out(columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["set_id", "h1", "part"])

        for batch in batches:
            for columns in reader.read(*(c.to_numpy() for c in batch.columns)):
                yield out(columns)
        yield out(reader.close())

    met = keys.select("key", "h1").repartition(F.col("key")).sortWithinPartitions("key", "h1")
    found = stored(met.mapInArrow(run, "set_id bigint, h1 bigint, part bigint"))
    sets = found.filter("part < 0").select("set_id", "h1").distinct()
    large = found.filter("part >= 0")
    if large.isEmpty():
        return sets
    parts = materialise(large.groupBy("set_id").agg(F.max("part").alias("last")))
    cells = large.join(parts, "set_id").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    cells = cells.filter("part <> other").select(
        F.xxhash64("set_id", F.least("part", "other"), F.greatest("part", "other")).alias("set_id"), "h1"
    )
    return sets.unionByName(cells)


def candidate_marks(sets: DataFrame) -> np.ndarray:
    """Bitmap over h1 modulo its size, as 64-bit words: 2 MB on the driver, whatever the input."""
    bit = F.pmod("h1", F.lit(BITMAP_BITS))
    words = sets.select(F.shiftright(bit, 6).alias("word"), F.expr("1L << cast(pmod(h1, 64) AS int)").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    marks = np.zeros(BITMAP_BITS // 64, np.uint64)
    marks[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return marks


def marked_lines(docs: DataFrame, text_col: str, marks: np.ndarray) -> DataFrame:
    """The lines whose bit is set, repeated lines once per task."""
    shipped = Shipped(docs.sparkSession, marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = shipped.get(), set()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for begin, end in slices(texts, SLICE_CHARS):
                lines = [x for text in texts[begin:end] for x in text.split("\n") if x.strip(SPACES)]
                if not lines:
                    continue
                digest = xxhash.xxh64_intdigest
                names = np.array([digest(x.encode(), HASH_SEED) for x in lines], np.uint64)
                place = (names % np.uint64(BITMAP_BITS)).astype(np.int64)
                hit = np.flatnonzero(own[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1))
                fresh = {int(names[i]): lines[i] for i in hit.tolist() if int(names[i]) not in seen}
                seen.update(fresh)
                if len(seen) > SEEN_LINES:
                    seen.clear()
                yield pa.RecordBatch.from_arrays([pa.array(list(fresh.values()), pa.string())], ["line"])

    rows = docs.select(text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "line string")


def line_name(line: str) -> str:
    """Both halves of a line's name in hexadecimal."""
    digest, data = xxhash.xxh64_intdigest, line.encode()
    return f"{digest(data, HASH_SEED):016x}{digest(data, SECOND_SEED):016x}"


def verified_links(members: DataFrame, settings: Settings) -> DataFrame:
    """Links ``a``, ``b`` (names as strings) that connect the similar lines of each set.

    ``members`` has set_id and the line; the names follow from the line and do not travel. A search from each line not yet reached compares it
    with those not yet reached, so a set of n lines gives fewer than n links. Lines whose sketches
    differ in more bits than similar lines can are not compared further; they can't be similar.
    """
    apart = (1 - settings.similarity) / (1 + settings.similarity) + 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, lines in whole_groups(batches):
            a, b = [], []
            starts, sizes = runs(ids)
            bits, counts = sketches(lines, settings.shingle)
            for start, size in zip(starts.tolist(), sizes.tolist(), strict=True):
                sets: list[CodedSets] = []  # made when the first pair needs it

                def alike(i: int, j: int) -> bool:
                    if (bits[i] ^ bits[j]).bit_count() > apart * (counts[i] + counts[j]):
                        return False
                    if not sets:
                        sets.append(CodedSets(lines[start : start + size].tolist(), settings.shingle))
                    return sets[0].similarity(i - start, j - start) >= settings.similarity

                open_ = list(range(1, size))
                stack = [0]
                while stack or open_:
                    if not stack:
                        stack.append(open_.pop(0))
                    i = stack.pop()
                    near = [j for j in open_ if alike(start + i, start + j)]
                    if near:
                        reached = set(near)
                        open_ = [j for j in open_ if j not in reached]
                        stack.extend(near)
                        a.extend([start + i] * len(near))
                        b.extend(start + j for j in near)
            if a:
                name = {i: line_name(lines[i]) for i in {*a, *b}}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name[i] for i in a]), pa.array([name[j] for j in b])], ["a", "b"]
                )

    dealt = members.select("set_id", "line").repartition(F.col("set_id")).sortWithinPartitions("set_id")
    return dealt.mapInArrow(run, "a string, b string")


def line_classes(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per line with a character other than white space, and the line that stands for it.

    Columns: doc_id, line_no (from 0), keep_doc_id, keep_line_no, copies (equal lines, itself included)
    and kept, true for exactly one line of each component: the one of smallest id, line number and
    place in the input. Equal lines are always in one component; so are lines of Jaccard similarity
    ``similarity`` or more, up to the recall of the bands, and lines linked through others. A line
    shorter than a shingle is similar to its equals only. Null and empty texts have no lines; a null id
    sorts first. Repeated rows repeat their lines. An empty table gives no rows; other columns are
    dropped.
    """
    names = stored(line_names(docs, id_col, text_col))
    sets = stored(candidate_sets(band_keys(docs, text_col, settings)))
    texts = marked_lines(docs, text_col, candidate_marks(sets))
    texts = texts.repartition(F.xxhash64("line")).select(F.xxhash64("line").alias("h1"), "line").distinct()
    roots = connected_components(verified_links(sets.join(texts, "h1"), settings))

    place = F.struct(F.col("doc_id"), F.col("line_no"), F.col("row"))
    half = lambda at: F.conv(F.substring("node", at, 16), 16, -10).cast("bigint")
    nodes = materialise(roots.select("root", half(1).alias("h1"), half(17).alias("h2")))
    # one row per line first, so that a very common line isn't joined occurrence by occurrence
    firsts = names.groupBy("h1", "h2").agg(F.min(place).alias("first"))
    inside = materialise(firsts.join(nodes, ["h1", "h2"]).select("h1", "h2", "root", "first"))
    best = materialise(inside.groupBy("root").agg(F.min("first").alias("keep")))
    near = materialise(inside.join(best, "root").select("h1", "h2", "keep"))
    named = with_group_values(names, ["h1", "h2"], [F.min(place).alias("first"), F.count(F.lit(1)).alias("copies")])
    out = named.join(near, ["h1", "h2"], "left").withColumn("keep", F.coalesce("keep", "first"))
    return out.select(
        "doc_id",
        "line_no",
        F.col("keep.doc_id").alias("keep_doc_id"),
        F.col("keep.line_no").alias("keep_line_no"),
        "copies",
        (F.col("keep") == place).alias("kept"),
    )


def drop_fuzzy_lines(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without the lines that another stands for; lines without a character stay.

    Ids are expected to be distinct. A null text stays null.
    """
    dropped = line_classes(docs, settings, id_col, text_col).filter("not kept")
    dropped = dropped.groupBy("doc_id").agg(F.collect_set("line_no").alias("_drop")).withColumnRenamed("doc_id", "_id")
    # the columns travel as one, so that none of them clashes with these
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = rows.join(dropped, F.col("_row").getField(id_col).eqNullSafe(F.col("_id")), "left")
    kept = F.filter(
        F.split(F.col("_row").getField(text_col), "\n"),
        lambda line, i: ~F.array_contains(F.coalesce("_drop", F.array().cast("array<int>")), i),
    )
    return rows.select(
        *[
            (F.array_join(kept, "\n") if c == text_col else F.col("_row").getField(c)).alias(c)
            for c in docs.columns
        ]
    )
