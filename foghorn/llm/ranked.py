"""Ranked lexical search by pipelined term partitioning.

Documents are cut into buckets of a bounded number, and a bucket's postings are split among term
owners by how common the term is. Items travel in bundles, one for every bucket: a bundle passes the
owners one after the other, rarest terms first, and meets at each the postings of its bucket (a cogroup).
The owner adds the integer contributions of its terms to the bundle's sparse accumulators, an entry for
each item and document met so far; so few entries travel until the last owner, who holds the common
terms, adds its part and hands on the best of each item. The best of all buckets are selected at the end.

Nothing is skipped: every document with a term of an item is scored in full. Statistics cover all
documents; the driver gets two totals, a bitmap of fixed size for the terms of the items, and the terms
that are in at least one document in ``STEPS[0]``, of which a document can hold only so many.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from foghorn.llm.common import Shipped, slices, stored, text_of
from foghorn.llm.lines import BITMAP_BITS, candidate_marks
from foghorn.operators.rows import row_numbers
from foghorn.session import materialise

#: Documents of a bucket, and the postings after which one is closed early.
BUCKET, BUCKET_POSTINGS = 4096, 2_000_000
#: Items of a bundle. A bundle and a bucket meet in one group of BUNDLE * BUCKET accumulators at most.
BUNDLE = 256
SLICE_CHARS = 4_000_000
CACHED_WORDS = 300_000
#: Contributions expanded at once.
CHUNK = 1 << 20
#: Owners 1, 2, ... hold terms that at least one in so many documents has; owner 0 the rest.
STEPS = (64, 8)

#: ASCII letters in lower case, digits, and all bytes of other characters; the rest separates terms.
_KEPT = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256)).lower()


@dataclass(frozen=True)
class Settings:
    top: int = 10
    weight_scale: int = 1000
    #: A document's length counts for ``slope`` parts in 100 of the norm.
    slope: int = 90
    tf_scale: int = 1_000_000_000
    tf_step: int = 1000
    norm_step: int = 8


def terms_of(text: str) -> list[bytes]:
    """ASCII letters in lower case, digits and other characters in unbroken runs."""
    return text.encode().translate(_KEPT).split()


class TermHashes(dict):
    """Signed 64-bit hashes of terms; 0 for those whose bit is not set."""

    def __init__(self, marks: np.ndarray | None = None):
        super().__init__()
        self.marks = marks

    def __missing__(self, term: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = xxhash.xxh64_intdigest(term) or 1
        if self.marks is not None:
            at = value % BITMAP_BITS
            value = value if int(self.marks[at >> 6]) >> (at & 63) & 1 else 0
        self[term] = value = value - (1 << 64) if value >> 63 else value
        return value


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item`` (a number for the row), ``item_id`` and ``h1``, the hash of each distinct term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = TermHashes()
        for batch in batches:
            found = [sorted({hashes[t] for t in terms_of(x)}) for x in batch.column(2).to_pylist()]
            rows = np.repeat(np.arange(len(found)), [len(x) for x in found])
            joined = np.array([h for x in found for h in x], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)), pa.array(joined)],
                ["item", "item_id", "h1"],
            )

    rows = items.select(
        F.monotonically_increasing_id().alias("item"),
        F.col(id_col).cast("bigint").alias("item_id"),
        text_of(text_col).alias("text"),
    )
    return rows.mapInArrow(run, "item bigint, item_id bigint, h1 bigint")


def postings(docs: DataFrame, id_col: str, text_col: str, marks: np.ndarray) -> DataFrame:
    """A row per bucket: its documents' ids and lengths, and the marked terms with their postings.

    Arrays: ``ids``; ``lengths`` (terms with repeats); ``terms`` with ``counts``, the documents that hold
    each; ``places`` of the documents in the bucket and ``tf``, term by term.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = TermHashes(shipped.get())
        ids: list = []
        lengths: list[int] = []
        held: list[np.ndarray] = []  # (term, place, tf) of the marked terms

        def close() -> pa.RecordBatch:
            found = np.concatenate(held, axis=1) if held else np.empty((3, 0), np.int64)
            found = found[:, np.lexsort((found[1], found[0]))]
            terms, counts = np.unique(found[0], return_counts=True)
            lists = (
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([lengths], pa.list_(pa.int64())),
                pa.array([terms], pa.list_(pa.int64())),
                pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
                pa.array([found[1].astype(np.int32)], pa.list_(pa.int32())),
                pa.array([found[2].astype(np.int32)], pa.list_(pa.int32())),
            )
            return pa.RecordBatch.from_arrays(list(lists), ["ids", "lengths", "terms", "counts", "places", "tf"])

        size = 0
        for batch in batches:
            texts = batch.column(1).to_pylist()
            names = batch.column(0).to_pylist()
            for begin, end in slices(texts, SLICE_CHARS):
                for i in range(begin, end):
                    words = terms_of(texts[i])
                    if not words:
                        continue
                    counted = Counter(map(hashes.__getitem__, words))
                    counted.pop(0, None)
                    row = np.empty((3, len(counted)), np.int64)
                    row[0] = list(counted)
                    row[1] = len(ids)
                    row[2] = list(counted.values())
                    held.append(row)
                    ids.append(names[i])
                    lengths.append(len(words))
                    size += len(counted)
                    if len(ids) == BUCKET or size >= BUCKET_POSTINGS:
                        yield close()
                        ids, lengths, held, size = [], [], [], 0
        if ids:
            yield close()

    shipped = Shipped(docs.sparkSession, marks)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(
        run,
        "ids array<bigint>, lengths array<bigint>, terms array<bigint>, counts array<int>, places array<int>, tf array<int>",
    )


def owned(buckets: DataFrame, owner: int, common: Shipped, n: int, total: int, settings: Settings) -> DataFrame:
    """The postings of one owner's terms by bucket, with the integer part of each that is independent of the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, owners = common.get()
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                bucket = row[0].as_py()
                ids, lengths, terms, counts, places, tf = (x.values.to_numpy(zero_copy_only=False) for x in row[1:])
                at = np.minimum(np.searchsorted(names, terms), max(len(names) - 1, 0))
                mine = np.zeros(len(terms), np.int64)
                if len(names):
                    mine = np.where(names[at] == terms, owners[at], 0)
                mine = mine == owner
                each = np.repeat(mine, counts)
                norm = [100 - settings.slope + settings.slope * x * n // total for x in lengths.tolist()]
                tf = tf[each].astype(np.int64)
                part = settings.tf_scale * tf // (
                    settings.tf_step * tf + settings.norm_step * np.array(norm, np.int64)[places[each]]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([bucket]),
                        pa.array([row[1].as_py()], pa.list_(pa.int64())),
                        *(pa.array([x.tobytes()], pa.binary()) for x in (
                            terms[mine], counts[mine].astype(np.int64), places[each].astype(np.int32), part
                        )),
                    ],
                    ["bucket", "ids", "terms", "counts", "places", "part"],
                )

    schema = "bucket bigint, ids array<bigint>, terms binary, counts binary, places binary, part binary"
    return buckets.select("bucket", "ids", "lengths", "terms", "counts", "places", "tf").mapInArrow(run, schema)


def add(
    scores: np.ndarray, items: np.ndarray, terms: np.ndarray, weights: np.ndarray, postings: tuple[np.ndarray, ...]
) -> None:
    """Adds weight * part for each (item, term) and posting of the term to ``scores``, items by documents."""
    names, counts, places, part = postings
    if not len(names) or not len(terms):
        return
    at = np.minimum(np.searchsorted(names, terms), len(names) - 1)
    hit = np.flatnonzero(names[at] == terms)
    at, item, weight = at[hit], items[hit], weights[hit]
    starts = np.cumsum(counts) - counts
    flat, width = scores.reshape(-1), scores.shape[1]
    ends = np.cumsum(counts[at])
    begin = 0
    while begin < len(at):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + CHUNK, side="right")))
        n = counts[at[begin:end]]
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) + np.repeat(starts[at[begin:end]] - first, n)
        target = np.repeat(item[begin:end] * width, n) + places[place]
        np.add.at(flat, target, np.repeat(weight[begin:end], n) * part[place])
        begin = end


def best(scores: np.ndarray, ids: list, top: int) -> list[tuple[int, int | None, int]]:
    """Of each row the entries above 0 of highest score, equal ones by ascending id, null ids last."""
    order = np.array([(1 << 63) - 1 if i is None else i for i in ids], np.int64)
    out = []
    for item, row in enumerate(scores):
        place = np.flatnonzero(row > 0)
        if len(place) > top:
            least = np.partition(row[place], len(place) - top)[len(place) - top]
            place = place[row[place] >= least]
        place = place[np.lexsort((order[place], -row[place]))][:top]
        out.extend((item, ids[p], int(row[p])) for p in place.tolist())
    return out


def _items(bundle: tuple) -> tuple[np.ndarray, ...]:
    return tuple(np.frombuffer(x, np.int64) for x in bundle)


BUNDLE_COLUMNS = "bucket bigint, bundle bigint, names binary, owners binary, items binary, terms binary, weights binary, at binary, scores binary"


def stage(bundles: DataFrame, own: DataFrame, owner: int, last: bool, settings: Settings) -> DataFrame:
    """The bundles after they have met one owner's postings; after the last one the best of each item."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.to_pylist()
        found = right.to_pylist()
        if not rows or not found:
            return empty
        row, mine = rows[0], found[0]
        ids = mine["ids"]
        owners, items, terms, weights = _items((row["owners"], row["items"], row["terms"], row["weights"]))
        names = np.frombuffer(row["names"], np.int64)
        scores = np.zeros((len(names), len(ids)), np.int64)
        scores.reshape(-1)[np.frombuffer(row["at"], np.int32)] = np.frombuffer(row["scores"], np.int64)
        now = owners == owner
        postings = tuple(
            np.frombuffer(mine[c], kind)
            for c, kind in (("terms", np.int64), ("counts", np.int64), ("places", np.int32), ("part", np.int64))
        )
        add(scores, items[now], terms[now], weights[now], postings)
        if last:
            chosen = best(scores, ids, settings.top)
            columns = list(zip(*chosen, strict=True)) or [(), (), ()]
            number = names[np.array(columns[0], np.int64)]
            return pa.table(
                {"item": pa.array(number), "doc_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.int64())}
            )
        at = np.flatnonzero(scores.reshape(-1)).astype(np.int32)
        row |= {"at": at.tobytes(), "scores": scores.reshape(-1)[at].tobytes()}
        return pa.Table.from_pylist([row], schema=empty.schema)

    if last:
        schema = "item bigint, doc_id bigint, score bigint"
        empty = pa.table({c: pa.array([], pa.int64()) for c in ("item", "doc_id", "score")})
    else:
        schema = BUNDLE_COLUMNS
        kinds = [x.strip().split() for x in schema.split(",")]
        empty = pa.table({c: pa.array([], pa.int64() if k == "bigint" else pa.binary()) for c, k in kinds})
    grouped = bundles.groupBy("bucket", "bundle").cogroup(own.groupBy("bucket", "bundle"))
    return grouped.applyInArrow(run, schema)


def bundled(terms: DataFrame, settings: Settings) -> DataFrame:
    """A row per bundle of items: numbers of the items, and owner, item, term and weight of each term, packed.

    ``terms`` has item, slot (its place in the bundle), bundle, owner, h1 and weight.
    """

    def run(table: pa.Table) -> pa.Table:
        item = table.column("item").to_numpy()
        names, slot = np.unique(item, return_inverse=True)
        pack = lambda x: pa.array([np.ascontiguousarray(x, np.int64).tobytes()], pa.binary())
        return pa.table(
            {
                "bundle": table.column("bundle").slice(0, 1),
                "names": pack(names),
                "owners": pack(table.column("owner").to_numpy()),
                "items": pack(slot),
                "terms": pack(table.column("h1").to_numpy()),
                "weights": pack(table.column("weight").to_numpy()),
            }
        )

    schema = "bundle bigint, names binary, owners binary, items binary, terms binary, weights binary"
    return terms.groupBy("bundle").applyInArrow(run, schema)


def term_weight(n: int, df: Column, settings: Settings) -> Column:
    return F.floor(settings.weight_scale * F.log((2 * n + 2) / (2 * df + 1))).cast("bigint")


def search(
    docs: DataFrame,
    items: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The highest-scoring documents of each item: item_id, rank (from 1), doc_id, score.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case; null and
    empty texts have none. A document scores the sum over the item's distinct terms of weight *
    ((10^9 * tf) div (1000 * tf + 8 * m)), with m = 100 - slope + (slope * n * N) div L, in 64-bit
    integers; only scores above 0 count. Equal scores are ranked by ascending id, null ids last, rows of
    one id in any order. Item rows that share an id are ranked apart; an item without terms, or without
    documents, gives no rows, as does an empty table. Terms are told apart by 64-bit hashes. Very long
    texts are whole. Other columns are dropped, whatever their names.
    """
    spark = docs.sparkSession
    nothing = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    wanted = materialise(item_terms(items, item_col, item_text_col))
    buckets = stored(
        postings(docs, id_col, text_col, candidate_marks(wanted)).withColumn("bucket", F.monotonically_increasing_id())
    )
    sums = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x)
    n, total = buckets.agg(F.sum(F.size("ids")), F.sum(sums)).first()[:]
    if not n:
        return nothing
    df = buckets.select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
    df = df.groupBy(F.col("t.terms").alias("h1")).agg(F.sum("t.counts").alias("df"))
    owner = sum((F.when(F.col("df") * step >= n, 1).otherwise(0) for step in STEPS), F.lit(0)).cast("bigint")
    numbered = row_numbers(wanted.select("item").distinct(), [F.col("item")])
    numbered = numbered.select("item", F.floor((F.col("row_number") - 1) / BUNDLE).cast("bigint").alias("bundle"))
    weighed = wanted.join(df, "h1").withColumns({"owner": owner, "weight": term_weight(n, F.col("df"), settings)})
    weighed = materialise(weighed.join(numbered, "item"))
    common = weighed.filter("owner > 0").select("h1", "owner").distinct().orderBy("h1").toArrow()
    common = Shipped(spark, (common.column("h1").to_numpy(), common.column("owner").to_numpy()))

    # every bundle visits every bucket: a stated query set against all rows, in blocks
    packed = materialise(bundled(weighed, settings))
    count = packed.count()
    numbers = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(max(count - 1, 0)).cast("bigint")))
    visits = buckets.select("bucket", numbers.alias("bundle"))
    bundles = visits.join(packed, "bundle").withColumns({c: F.lit(b"") for c in ("at", "scores")})
    bundles = bundles.select(*[x.split()[0] for x in BUNDLE_COLUMNS.split(", ")])
    for step in range(len(STEPS) + 1):
        own = owned(buckets, step, common, n, total, settings).withColumn("bundle", numbers)
        bundles = stage(bundles, own, step, step == len(STEPS), settings)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = bundles.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= settings.top)
    named = wanted.select("item", "item_id").distinct()
    return ranked.join(named, "item").select("item_id", "rank", "doc_id", "score")


def search_sql(settings: Settings = Settings()) -> str:
    """DuckDB's statement for the tables ``documents`` and ``benchmark``."""
    s = settings
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    terms = (
        f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), "
        r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    )
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS d, doc_id, {terms} AS t FROM documents),
n AS (SELECT count(*) AS n, sum(len(t))::BIGINT AS l FROM d WHERE len(t) > 0),
p AS MATERIALIZED (SELECT d, t, count(*) AS tf FROM (SELECT d, unnest(t) AS t FROM d) GROUP BY ALL),
w AS (
  SELECT t, floor({s.weight_scale} * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM p, n GROUP BY t, n
), i AS (
  SELECT DISTINCT r, item_id, t FROM (
    SELECT r, item_id, unnest(t) AS t FROM (SELECT row_number() OVER () AS r, item_id, {terms} AS t FROM benchmark))
), m AS (
  SELECT d, doc_id, {100 - s.slope} + ({s.slope} * len(t) * n) // l AS m FROM d, n WHERE len(t) > 0
), s AS (
  SELECT r, item_id, d, doc_id,
         sum(w * (({s.tf_scale} * tf) // ({s.tf_step} * tf + {s.norm_step} * m)))::BIGINT AS score
  FROM i JOIN w USING (t) JOIN p USING (t) JOIN m USING (d) GROUP BY ALL
), k AS (
  SELECT item_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM s WHERE score > 0
)
SELECT * FROM k WHERE rank <= {s.top}"""
