"""An event table of monthly folders with an idempotent append that rewrites only the months it touches.

Layout under the table's folder::

    month=2024-01/version=<v>/part-*.parquet   the events of a month, in files sorted by time
    _filter/month=2024-01/version=<v>/         a bitmap of the keys of the month, if keys hold no time
    _manifest/00000007.json                    the state after the seventh append

An append reads the latest manifest, merges the touched months into folders of its own, and then puts
the next manifest in place by a rename that fails if another append has got there first. It then starts
over from the rival's state, so neither loses rows, and readers of a manifest never see half an append.
An event's month follows from its time in UTC, so with a key that holds the time the touched months are
those of the incoming rows. For other keys a bitmap per month tells which months may hold an incoming
key: it is joined by bitmap word, and a bit set by chance costs the rewrite of a month, nothing else.
Folders that a commit replaces are deleted unless they are asked to be kept for running readers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from foghorn.operators.rows import keep_one
from foghorn.plans.events import EVENT_KEY, append_keep_last, both_batches, canonical_events
from foghorn.schemas import EVENT
from foghorn.session import ensure_checkpoint_dir

UNDATED = "none"
FILTER_BITS = 1 << 22
#: Events of a file, some hundred MB.
FILE_ROWS = 2_000_000
#: Rows of one key that may meet in a task, and the counters per month that tell of more.
HOT_ROWS = 1_000_000
COUNTERS = 512
ATTEMPTS = 20


class Conflict(Exception):
    """Another append has committed this version."""


@dataclass
class Manifest:
    """``months`` has the folder's version and the number of rows of each month; ``key`` that of the filters."""

    version: int = 0
    key: list[str] = field(default_factory=list)
    months: dict[str, dict] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(m["rows"] for m in self.months.values())


class _Files:
    """The Hadoop file system of a path, whatever its scheme."""

    def __init__(self, spark: SparkSession, path: str):
        self.gateway = spark.sparkContext._gateway
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = path.rstrip("/")
        self.fs = self.at("").getFileSystem(self.conf)

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        where = self.at(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(where)] if self.fs.exists(where) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, name: str, content: str) -> None:
        """Write a file that must not be there yet, complete or not at all."""
        staged = self.at(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(staged, False)
        stream.write(bytearray(content.encode()))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.at("").toUri(), self.conf)
        kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.gateway.new_array(kind, 1)
        options[0] = kind.NONE
        try:
            context.rename(context.makeQualified(staged), context.makeQualified(self.at(name)), options)
        except Exception as error:
            self.fs.delete(staged, False)
            if self.fs.exists(self.at(name)):
                raise Conflict(name) from error
            raise

    def drop(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def latest(spark: SparkSession, path: str) -> Manifest | None:
    """The committed state; None where the folder is no event table."""
    files = _Files(spark, path)
    versions = [n for n in files.names("_manifest") if n.endswith(".json")]
    return Manifest(**json.loads(files.read(f"_manifest/{max(versions)}"))) if versions else None


def month_of(ts: Column) -> Column:
    """``yyyy-MM`` in UTC, whatever the session's time zone."""
    day = F.date_from_unix_date(F.floor(F.unix_micros(ts) / F.lit(86_400_000_000)).cast("int"))
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(UNDATED))


def _folders(path: str, manifest: Manifest, months: Sequence[str], top: str = "") -> list[str]:
    root = path.rstrip("/") + top
    return [f"{root}/month={m}/version={manifest.months[m]['version']}" for m in sorted(months)]


def _load(spark: SparkSession, path: str, manifest: Manifest, months: Sequence[str]) -> DataFrame:
    if not months:
        return spark.createDataFrame([], EVENT)
    return spark.read.schema(EVENT).parquet(*_folders(path, manifest, months))


def read(spark: SparkSession, path: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """The events of the latest state with since <= ts < until (UTC times as text; None: open).

    Only the months between are opened, and within them files and row groups whose times lie outside
    are skipped by their statistics. Undated events are read only without bounds.
    """
    manifest = latest(spark, path) or Manifest()
    low, high = (since or "")[:7], (until or "9999-99")[:7]
    months = [m for m in manifest.months if since is None and until is None or m != UNDATED and low <= m <= high]
    events = _load(spark, path, manifest, months)
    if since is not None:
        events = events.filter(F.col("ts") >= _instant(since))
    if until is not None:
        events = events.filter(F.col("ts") < _instant(until))
    return events


def _instant(text: str) -> Column:
    return F.to_timestamp(F.lit(f"{text[:10]} {text[11:] or '00:00:00'}+00:00"))


def _bits(rows: DataFrame, key: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Words of the bitmap of the keys, combined before the shuffle."""
    placed = rows.withColumn("_place", F.pmod(F.xxhash64(*key), F.lit(FILTER_BITS)))
    words = placed.select(
        *by, F.shiftright("_place", 6).alias("word"), F.expr("1L << cast(_place % 64 AS int)").alias("bit")
    )
    return words.groupBy(*by, "word").agg(F.bit_or("bit").alias("bits"))


def _months_and_heat(incoming: DataFrame, key: Sequence[str]) -> tuple[list[str], bool]:
    """The months of rows, and whether a key may have more than ``HOT_ROWS`` of them.

    Rows are counted by month and hash of the key, so a counter far above its month's mean holds a hot key.
    """
    counter = F.pmod(F.xxhash64(*key), F.lit(COUNTERS))
    counts = incoming.groupBy("month", counter.alias("_counter")).count()
    by_month = counts.groupBy("month").agg(F.max("count").alias("most"), F.sum("count").alias("rows")).collect()
    return [r["month"] for r in by_month], any(r["most"] > HOT_ROWS + 4 * r["rows"] / COUNTERS for r in by_month)


def touched_months(
    spark: SparkSession, path: str, manifest: Manifest, incoming: DataFrame, own: list[str], key: Sequence[str]
) -> list[str]:
    """Months that an append has to rewrite: ``own``, those of its rows, and those that may hold one of its keys."""
    others = sorted(set(manifest.months) - set(own))
    if "ts" in key or not others:
        return own
    if list(key) != manifest.key:
        return own + others
    stored = None
    for month in others:
        part = spark.read.parquet(*_folders(path, manifest, [month], "/_filter"))
        part = part.withColumn("month", F.lit(month))
        stored = part if stored is None else stored.unionByName(part)
    asked = _bits(incoming, key, []).withColumnRenamed("bits", "asked")
    met = stored.join(asked, "word").filter(F.col("bits").bitwiseAND(F.col("asked")) != 0)
    return own + [r[0] for r in met.select("month").distinct().collect()]


def append(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    source: str = "",
    signal_type: str = "",
    key: Sequence[str] = EVENT_KEY,
    keep_replaced: bool = False,
    before_commit: Callable[[], None] | None = None,
) -> int:
    """Append events, rows of a known key replacing the old ones; returns how many rows the table grew by.

    Repeating an append changes nothing but the versions of its months. A failed or lost append leaves
    the table as it was. A folder of plain Parquet is taken over by its first append.
    ``before_commit`` is called before each attempt to commit, for tests of rival appends.
    """
    staged = f"{ensure_checkpoint_dir(spark)}/incoming-{uuid.uuid4().hex}"
    try:
        # written once: each attempt, and each pass of one, meets the same rows; defaults of absent columns are not
        given = [f for f in EVENT.fields if f.name in incoming.columns] or EVENT.fields
        canonical_events(incoming, source, signal_type).select(*[f.name for f in given]).write.parquet(staged)
        kept = canonical_events(spark.read.schema(T.StructType(given)).parquet(staged), source, signal_type)
        return _append(spark, path, kept.withColumn("month", month_of(F.col("ts"))), key, keep_replaced, before_commit)
    finally:
        _Files(spark, staged).drop("")


def _append(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    key: Sequence[str],
    keep_replaced: bool,
    before_commit: Callable[[], None] | None,
) -> int:
    files = _Files(spark, path)
    own, hot = _months_and_heat(incoming, key)
    for _ in range(ATTEMPTS):
        manifest = latest(spark, path)
        plain = manifest is None and files.fs.exists(files.at("")) and bool(files.names(""))
        manifest = manifest or Manifest()
        version = f"{manifest.version + 1:08d}-{uuid.uuid4().hex[:8]}"
        if plain:
            from foghorn.sources.readers import read_plain_events

            old, replaced = read_plain_events(spark, path), [n for n in files.names("") if n[0] not in "_."]
            months, before = None, old.count()
        else:
            months = touched_months(spark, path, manifest, incoming, own, key)
            held = [m for m in months if m in manifest.months]
            old, replaced = _load(spark, path, manifest, held), _folders("", manifest, held)
            before = sum(manifest.months[m]["rows"] for m in held)
        batch = incoming.drop("month")
        # with the time in the key its rows follow each other in time order, unless a number in it has two zeros
        timed = "ts" in key and not any(isinstance(EVENT[c].dataType, T.DoubleType) for c in key)
        if timed and not hot and not plain and (not held or list(key) == manifest.key):
            ranged = _ranged(both_batches(old, batch), version, key)
        else:
            ranged = _ranged(append_keep_last(old, batch, key), version)
        counts = _write(ranged, path, version, key)
        after = Manifest(
            manifest.version + 1,
            list(key) if months is None or set(manifest.months) <= set(months) or list(key) == manifest.key else [],
            {m: v for m, v in manifest.months.items() if months is not None and m not in months}
            | {m: {"version": version, "rows": n} for m, n in counts.items()},
        )
        if before_commit:
            before_commit()
        try:
            files.put_new(f"_manifest/{after.version:08d}.json", json.dumps(vars(after), indent=1, sort_keys=True))
        except Conflict:
            for m in counts:
                files.drop(f"month={m}/version={version}")
                files.drop(f"_filter/month={m}/version={version}")
            continue
        if not keep_replaced:
            for name in replaced:
                files.drop(name.lstrip("/"))
                files.drop(f"_filter/{name.lstrip('/')}")
        return max(0, sum(counts.values()) - before)
    raise Conflict(f"{path}: {ATTEMPTS} attempts to append met rival appends")


def _ranged(events: DataFrame, version: str, key: Sequence[str] = ()) -> DataFrame:
    """Events in ranges of time, of which a hot month takes as many as it fills, with their month and version.

    With a ``key`` that holds the time one row of each stays: its rows lie in one range, so they are moved once,
    and sorting them by time first compares numbers and leaves little to do for the order of the files.
    """
    by = ["ts", *[c for c in key or EVENT_KEY if c != "ts"]]
    ranged = events.repartitionByRange(*by)
    if key:
        rest = [c for c in events.columns if c not in (*key, "_batch")]
        ranged = keep_one(ranged, by, [F.col(c).desc() for c in ["_batch", *rest]]).drop("_batch")
    month = month_of(F.col("ts"))
    # a constant that is kept in a sort order, as the writer asks for the order of its folders
    return ranged.withColumns({"month": month, "version": F.concat(F.lit(version), F.substring(month, 1, 0))})


def _write(ranged: DataFrame, path: str, version: str, key: Sequence[str]) -> dict[str, int]:
    """Write events as a version of their months, in files sorted by time; rows by month."""
    spark = ranged.sparkSession
    order = ["month", "version", "ts", *[c for c in EVENT_KEY if c != "ts"]]
    writer = ranged.sortWithinPartitions(*order).write.mode("append").option("maxRecordsPerFile", FILE_ROWS)
    writer.partitionBy("month", "version").parquet(path)
    files = _Files(spark, path)
    months = [n.split("=", 1)[1] for n in files.names("") if n.startswith("month=")]
    months = [m for m in months if files.fs.exists(files.at(f"month={m}/version={version}"))]
    if not months:
        return {}
    state = Manifest(0, [], {m: {"version": version} for m in months})
    written = _load(spark, path, state, months).withColumn("month", month_of(F.col("ts")))
    if "ts" not in key:
        bits = _bits(written, key, ["month"]).withColumn("version", F.lit(version))
        bits.write.mode("append").partitionBy("month", "version").parquet(path.rstrip("/") + "/_filter")
    return {r[0]: r[1] for r in written.groupBy("month").count().collect()}
