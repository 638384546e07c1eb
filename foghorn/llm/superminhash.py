"""Near duplicates by SuperMinHash signatures over word shingles, banding, verification and union-find.

1. One pass over the texts: a text's shingles become 64-bit hashes, its set. Every element walks
   through the positions of the signature along its own permutation and offers step + fraction at
   each; the least offer stays. Offers of one step lie below those of the next, so the walk stops at the step that no
   position needs any more: a few steps for texts of some hundred words. Out come the keys of the
   bands, and a parity sketch of the set, some four bits per shingle.
2. Texts that share a band key are a candidate set; sets that several bands agree on are taken once.
   Parity bits in which two sketches differ never exceed the elements that only one set has, so they
   rule pairs out strictly. A search through the pairs left gives a forest of edges for each set.
3. The full sets of the texts on edges, and no others, are computed in a second pass and joined to the
   edges; their intersection decides. The candidate sets of edges that fail, as far as true links don't
   connect their members anyway, are searched once more with the full sets at hand.
4. A key with more than ``CELL`` texts isn't dealt out as pairs. First each of its texts is compared with
   one hub, the text that has most of the large keys: where the key is one group of near copies, that
   connects them by as many links as texts. Only keys that still hold several components are cut into
   cells, in which those outside the hub's component meet the rest.
5. Components of the links are found by distributed union-find.

Texts of one word sequence are one node throughout, so copies cost a row each.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from foghorn.llm.common import Shipped, slices, stored, text_of
from foghorn.llm.components import connected_components, runs, whole_groups
from foghorn.llm.lines import BITMAP_BITS, candidate_marks, candidate_sets
from foghorn.session import materialise

CELL = 1024
SLICE_CHARS = 2_000_000
CACHED_WORDS = 300_000
SEEN_TEXTS = 200_000
#: Elements that walk together; the state of the walk is this times the length of the signature.
WALKERS = 1 << 15
LEAST_BITS, MOST_BITS = 256, 1 << 18


@dataclass(frozen=True)
class Settings:
    """Of links at a similarity of 0.8, 32 bands of 6 rows miss 6 in 100,000, of those at 0.9 none in 10^10."""

    shingle: int = 4
    bands: int = 32
    rows: int = 6
    #: similarity as a ratio of integers
    numerator: int = 80
    denominator: int = 100


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, looked up while the word is among those met lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def words_of(text: str) -> list[bytes]:
    """Runs of other characters than ASCII white space, A-Z in lower case."""
    return text.encode().lower().split()


def shingle_set(words: Sequence[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the shingles; fewer words are one shingle, no words none."""
    if not words:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - size + 1)
    total = np.full(n, min(len(words), size), np.uint64)  # so that lengths differ
    for i in range(min(len(words), size)):
        total = total * np.uint64(0x9E3779B97F4A7C15) + each[i : i + n]
    return np.unique(_mixed(total))


def signatures(sets: Sequence[np.ndarray], length: int) -> np.ndarray:
    """The SuperMinHash signature of each set: (step << 32) + fraction, the least of all elements' offers."""
    least = np.full((len(sets), length), np.iinfo(np.uint64).max, np.uint64)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    for begin, end in slices(sets, WALKERS):
        hashes = np.concatenate(sets[begin:end])
        owners = np.repeat(np.arange(begin, end), sizes[begin:end])
        for at in range(0, len(hashes), WALKERS):  # parts of a large set: the least is the least of all parts
            _walk(hashes[at : at + WALKERS], owners[at : at + WALKERS], least)
    return least


def _walk(hashes: np.ndarray, owners: np.ndarray, least: np.ndarray) -> None:
    length = least.shape[1]
    flat = least.reshape(-1)
    order = np.empty((len(hashes), length), np.uint16)
    order[:] = np.arange(length, dtype=np.uint16)
    for step in range(length):
        drawn = _mixed(hashes + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        other = step + ((drawn & np.uint64(0xFFFFFFFF)) % np.uint64(length - step)).astype(np.int64)
        rows = np.arange(len(hashes))
        place = order[rows, other]
        order[rows, other] = order[:, step]  # the place drawn is used up
        offer = (np.uint64(step) << np.uint64(32)) + (drawn >> np.uint64(32))
        np.minimum.at(flat, owners * length + place, offer)
        named = owners[np.concatenate([[True], owners[1:] != owners[:-1]])] if len(owners) else owners
        ended = least[named].max(axis=1) < np.uint64(step + 1) << np.uint64(32)
        if ended.all():
            return
        if ended.any():
            stay = ~ended[np.searchsorted(named, owners)]
            hashes, owners, order = hashes[stay], owners[stay], order[stay]


def band_keys(least: np.ndarray, settings: Settings) -> np.ndarray:
    """A matrix of sets by bands of 64-bit keys."""
    parts = least.reshape(len(least), settings.bands, settings.rows)
    keys = np.broadcast_to(_mixed(np.arange(1, settings.bands + 1, dtype=np.uint64)), parts.shape[:2]).copy()
    for r in range(settings.rows):
        keys = _mixed(keys ^ parts[:, :, r]) + np.uint64(r)
    return keys


def parity_sketch(items: np.ndarray) -> np.ndarray:
    """Bits that tell whether an odd number of elements falls on them, as 64-bit words; four bits an element or more."""
    bits = LEAST_BITS
    while bits < min(4 * len(items), MOST_BITS):
        bits *= 2
    place = (items ^ (items >> np.uint64(29))) & np.uint64(bits - 1)
    out = np.zeros(bits // 64, np.uint64)
    np.bitwise_xor.at(out, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    return out


def _folded(words: np.ndarray, size: int) -> np.ndarray:
    """Sketches along the last axis as those of ``size`` words, a power of two lower."""
    while words.shape[-1] > size:
        half = words.shape[-1] // 2
        words = words[..., :half] ^ words[..., half:]
    return words


class Searched:
    """Members of a candidate set that may be similar by their sizes and sketches."""

    def __init__(self, sizes: np.ndarray, sketches: Sequence[np.ndarray], settings: Settings):
        self.sizes, self.sketches, self.s = sizes, sketches, settings
        lengths = np.fromiter(map(len, sketches), np.int64, len(sketches))
        self.classes = {}
        for length in np.unique(lengths).tolist():
            members = np.flatnonzero(lengths == length)
            self.classes[length] = members, np.stack([sketches[i] for i in members])
        self.open = np.ones(len(sizes), bool)

    def near(self, i: int) -> np.ndarray:
        """Open members that no bound rules out as similar to ``i``."""
        low, high = self.s.numerator, self.s.denominator
        own, size = self.sketches[i], self.sizes[i]
        out = []
        for length, (members, matrix) in self.classes.items():
            at = np.flatnonzero(self.open[members])
            other = self.sizes[members[at]]
            at = at[np.minimum(other, size) * high >= np.maximum(other, size) * low]
            if len(at):
                shared = min(length, len(own))
                apart = np.bitwise_count(_folded(matrix[at], shared) ^ _folded(own, shared)).sum(axis=1, dtype=np.int64)
                # similarity is (sum - apart) / (sum + apart) at best
                total = self.sizes[members[at]] + size
                out.append(members[at[high * (total - apart) >= low * (total + apart)]])
        return np.concatenate(out) if out else np.empty(0, np.int64)


def forest(searched: Searched, roots: Sequence, exact: Sequence[np.ndarray] | None) -> list[tuple[int, int]]:
    """Edges that connect the members between which no bound stands; with full sets, the similar ones.

    Members of one root are connected already.
    """
    kin: dict[object, list[int]] = {}
    for i, root in enumerate(roots):
        kin.setdefault(root, []).append(i)
    full: dict[int, set[int]] = {}

    def alike(i: int, j: int) -> bool:
        for k in (i, j):
            if k not in full:
                full[k] = set(exact[k].tolist())
        both = len(full[i] & full[j])
        return searched.s.denominator * both >= searched.s.numerator * (len(full[i]) + len(full[j]) - both)

    edges = []
    for seed in range(len(searched.sizes)):
        if not searched.open[seed]:
            continue
        stack = kin[roots[seed]].copy()
        searched.open[stack] = False
        while stack and searched.open.any():
            i = stack.pop()
            for j in searched.near(i).tolist():
                if searched.open[j] and (exact is None or alike(i, j)):
                    edges.append((i, j))
                    stack.extend(kin[roots[j]])
                    searched.open[kin[roots[j]]] = False
    return edges


def scan(docs: DataFrame, settings: Settings, id_col: str, text_col: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, node, h1, n; band keys and sketch at a task's first row of a node.

    A node is the 128-bit digest of the word sequence, null where there is no word; h1 is its half.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for begin, end in slices(texts, SLICE_CHARS):
                sets, names, fresh = [], [], []
                for i in range(begin, end):
                    words = words_of(texts[i])
                    sets.append(shingle_set(words, settings.shingle, hashes))
                    names.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                    if words and names[-1] not in seen:
                        seen.add(names[-1])
                        fresh.append(i - begin)
                if len(seen) > SEEN_TEXTS:
                    seen.clear()
                keys: list = [None] * len(sets)
                sketches: list = [None] * len(sets)
                found = band_keys(signatures([sets[i] for i in fresh], settings.bands * settings.rows), settings)
                for i, row in zip(fresh, found.view(np.int64), strict=True):
                    keys[i], sketches[i] = row, parity_sketch(sets[i]).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin),
                        pa.array(names, pa.binary()),
                        pa.array([n and int.from_bytes(n[:8], "little", signed=True) for n in names], pa.int64()),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array(keys, pa.list_(pa.int64())),
                        pa.array(sketches, pa.binary()),
                    ],
                    ["doc_id", "node", "h1", "n", "keys", "sketch"],
                )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, node binary, h1 bigint, n bigint, keys array<bigint>, sketch binary")


def marked_sets(docs: DataFrame, text_col: str, marks: np.ndarray, settings: Settings) -> DataFrame:
    """``node`` and ``items``, the full sets of the texts whose bit is set, each once."""
    shipped = Shipped(docs.sparkSession, marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, hashes, seen = shipped.get(), WordHashes(), set()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for begin, end in slices(texts, SLICE_CHARS):
                names, items = [], []
                for text in texts[begin:end]:
                    words = words_of(text)
                    name = xxhash.xxh3_128_digest(b" ".join(words))
                    at = int.from_bytes(name[:8], "little") % BITMAP_BITS
                    if words and int(own[at >> 6]) >> (at & 63) & 1 and name not in seen:
                        seen.add(name)
                        names.append(name)
                        items.append(shingle_set(words, settings.shingle, hashes).view(np.int64))
                if len(seen) > SEEN_TEXTS:
                    seen.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.binary()), pa.array(items, pa.list_(pa.int64()))], ["node", "items"]
                )

    sets = docs.select(text_of(text_col).alias("text")).mapInArrow(run, "node binary, items array<bigint>")
    return sets.dropDuplicates(["node"])


def forests(members: DataFrame, settings: Settings, exact: bool = False) -> DataFrame:
    """``set_id``, ``a``, ``b``: a forest of each candidate set, of true links if the members have their ``items``.

    A task holds one set at a time, which is bounded by ``CELL`` members.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, nodes, sizes, sketches, roots, *items in whole_groups(batches):
            out: list[tuple[int, bytes, bytes]] = []
            for start, size in zip(*(x.tolist() for x in runs(ids)), strict=True):
                group = slice(start, start + size)
                held = [np.frombuffer(x, np.uint64) for x in sketches[group]]
                searched = Searched(sizes[group].astype(np.int64), held, settings)
                full = items[0][group] if exact else None
                for i, j in forest(searched, roots[group].tolist(), full):
                    out.append((ids[start], *sorted((nodes[start + i], nodes[start + j]))))
            columns = zip(*out, strict=True) if out else ([], [], [])
            kinds = (pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["set_id", "a", "b"]
            )

    rows = members.select("set_id", "node", "n", "sketch", "root", *(["items"] if exact else []))
    dealt = rows.repartition(F.col("set_id")).sortWithinPartitions("set_id", "node")
    return dealt.mapInArrow(run, "set_id bigint, a binary, b binary")


def verified(edges: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """``a``, ``b``, ``alike`` of distinct edges: the intersection of the full sets decides."""
    one = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("bigint")
    pairs = edges.join(one, "a").join(two, "b").select("a", "b", both.alias("both"), F.size("x").alias("n"), F.size("y").alias("m"))
    alike = F.lit(settings.denominator) * F.col("both") >= F.lit(settings.numerator) * (F.col("n") + F.col("m") - F.col("both"))
    return pairs.select("a", "b", alike.alias("alike"))


def hubs(inside: DataFrame) -> DataFrame:
    """``key`` and ``hub``: of the members ``h1`` of each large key the one that has most large keys."""
    degree = materialise(inside.groupBy("h1").agg(F.count(F.lit(1)).alias("degree")))
    most = inside.join(degree, "h1").groupBy("key").agg(F.max(F.struct("degree", "h1")).alias("most"))
    return materialise(most.select("key", F.col("most.h1").alias("hub"), F.col("most.degree").alias("degree")))


def cells(inside: DataFrame, hub: DataFrame, rooted: DataFrame, cell: int) -> DataFrame:
    """``set_id`` and ``h1`` of the large keys that are several components.

    ``rooted`` has h1 and root. The members of the hub's component are cut into parts, and so are the
    others; each part of the others meets every part of either.
    """
    named = materialise(inside.join(rooted, "h1").select("key", "h1", "root"))
    centre = hub.join(rooted.select(F.col("h1").alias("hub"), F.col("root").alias("centre")), "hub").select("key", "centre")
    named = named.join(materialise(centre), "key")
    named = named.withColumn("out", (F.col("root") != F.col("centre")).cast("int")).drop("root", "centre")
    parts = lambda n: F.ceil(n / (cell // 2)).cast("int")
    count = named.groupBy("key").agg(
        parts(F.sum(1 - F.col("out"))).alias("near_parts"), parts(F.sum("out")).alias("far_parts")
    )
    named = named.join(materialise(count.filter("far_parts > 0")), "key")
    own = F.pmod(F.xxhash64("h1"), F.when(F.col("out") == 1, F.col("far_parts")).otherwise(F.col("near_parts")))
    named = named.withColumn("part", own.cast("int"))
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    near = F.transform(upto("far_parts"), lambda q: F.xxhash64("key", F.lit("near"), "part", q))
    far = F.concat(
        F.transform(upto("near_parts"), lambda p: F.xxhash64("key", F.lit("near"), p, "part")),
        F.transform(
            upto("far_parts"),
            lambda q: F.xxhash64("key", F.lit("far"), F.least(q, F.col("part")), F.greatest(q, F.col("part"))),
        ),
    )
    return named.select(F.explode(F.when(F.col("out") == 1, far).otherwise(near)).alias("set_id"), "h1")


def links(rows: DataFrame, docs: DataFrame, text_col: str, settings: Settings, cell: int = CELL) -> DataFrame:
    """Pairs ``a``, ``b`` of nodes with the components of the verified links among all that the bands bring together."""
    nodes = rows.filter("keys is not null")
    met = nodes.select("node", "h1", "keys").dropDuplicates(["node"]).select(F.explode("keys").alias("key"), "h1")
    count = met.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    large = materialise(count.filter(F.col("n") > cell).select("key"))
    hot = not large.isEmpty()
    sets = stored(candidate_sets(met.join(large, "key", "left_anti") if hot else met, cell))
    wanted = sets.select("h1")
    if hot:
        inside = stored(met.join(large, "key"))
        wanted = wanted.unionByName(inside.select("h1"))
    full = stored(marked_sets(docs, text_col, candidate_marks(wanted), settings))
    slim = nodes.select("h1", "node", "n", "sketch").dropDuplicates(["node"])
    slim = stored(slim.join(full.select("node"), "node", "left_semi"))
    rooted = slim.withColumn("root", F.col("node"))
    if hot:
        hub = hubs(inside)
        pairs = inside.join(hub, "key").groupBy("h1").agg(F.max(F.struct("degree", "hub")).alias("most"))
        pairs = pairs.select("h1", F.col("most.hub").alias("hub")).filter("h1 <> hub")
        name = slim.select("h1", F.col("node").alias("a"))
        pairs = pairs.join(name, "h1").join(name.withColumnsRenamed({"h1": "hub", "a": "b"}), "hub")
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        stars = stored(verified(pairs, full, settings))
        rooted = with_roots(slim, stars)
        sets = stored(sets.unionByName(cells(inside, hub, materialise(rooted.select("h1", "root")), cell)))
    found = stored(forests(sets.join(rooted, "h1"), settings))
    known = verified(found.select("a", "b").distinct(), full, settings)
    known = stored(known.unionByName(stars).distinct() if hot else known)
    again = materialise(found.join(known.filter("not alike"), ["a", "b"]).select("set_id").distinct())
    true = known.filter("alike").select("a", "b")
    if again.isEmpty():
        return true
    rooted = stored(with_roots(slim, known))
    part = stored(sets.join(again, "set_id").join(rooted, "h1").select("set_id", "node", "root"))
    apart = part.groupBy("set_id").agg(F.countDistinct("root").alias("roots")).filter("roots > 1")
    part = part.join(materialise(apart.select("set_id")), "set_id")
    part = part.join(slim.drop("h1"), "node").join(full, "node")
    # a root stands for the links that lead to it
    tied = rooted.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    return tied.unionByName(stored(forests(part, settings, exact=True)).select("a", "b"))


def with_roots(slim: DataFrame, known: DataFrame) -> DataFrame:
    """``slim`` with the root that each node has by the true ones of ``known`` edges."""
    roots = connected_components(known.filter("alike"), keep=stored).select("node", "root")
    return slim.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def near_duplicates(
    docs: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
    cell: int = CELL,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    The set of a text holds its distinct shingles of ``shingle`` words; a text of fewer words is one
    shingle. Rows are linked if intersection over union is at least numerator / denominator. Links are
    confirmed on the full sets, as 64-bit hashes of the shingles; what the bands may miss is stated by
    Settings. A component is named by the smallest id that can be reached, the row's own included, and
    ``kept`` is true where that is the row's own: rows that share the smallest id are all kept. A text
    without words, or null, has the empty set and is linked with nothing, not even another such text.
    A null id names a component only if all its ids are null. Very long texts are whole sets; their
    sketches stop growing at 2^18 bits, after which more pairs reach the exact test. An empty table
    gives no rows; other columns are dropped, whatever their names.
    """
    rows = stored(scan(docs, settings, id_col, text_col))
    found = connected_components(links(rows, docs, text_col, settings, cell), keep=stored)
    worded = rows.filter("node is not null").select("doc_id", "node", "n")
    marks = worded.groupBy("node").agg(F.min("doc_id").alias("least"))
    named = materialise(
        marks.join(found, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    )
    names = materialise(named.groupBy("root").agg(F.min("least").alias("component_id")))
    # written, so that the next join shuffles both sides and adaptive execution can split a hot node
    named = materialise(named.join(names, "root").select("node", "component_id"))
    out = worded.join(named, "node").select("doc_id", "n", "component_id")
    empty = rows.filter("node is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    out = out.unionByName(empty)
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def near_duplicates_sql(settings: Settings = Settings()) -> str:
    """DuckDB's statement for the table ``documents``: all pairs that share a shingle, and reachability."""
    k = settings.shingle
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'),
                            '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), s AS MATERIALIZED (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {k - 2}),
                                      lambda i: array_to_string(w[i:i + {k - 1}], ' '))) END AS s
  FROM w
), e AS MATERIALIZED (SELECT r, hash(x) AS x FROM (SELECT r, unnest(s) AS x FROM s)),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS n FROM e a JOIN e b ON a.x = b.x AND a.r < b.r GROUP BY ALL),
l AS MATERIALIZED (
  SELECT a, b FROM p JOIN s x ON x.r = a JOIN s y ON y.r = b
  WHERE {settings.denominator} * n >= {settings.numerator} * (len(x.s) + len(y.s) - n)
), t(r, c) AS (
  SELECT r, r FROM s UNION
  SELECT t.r, n.b FROM t JOIN (SELECT a, b FROM l UNION ALL SELECT b, a FROM l) n ON n.a = t.c
)
SELECT x.doc_id, len(x.s) AS n_shingles, min(y.doc_id) AS component_id,
       x.doc_id IS NOT DISTINCT FROM min(y.doc_id) AS kept
FROM t JOIN s x ON x.r = t.r JOIN s y ON y.r = t.c GROUP BY t.r, x.doc_id, len(x.s)"""
