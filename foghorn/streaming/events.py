"""Streaming append, tumbling volume and enrichment of event streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from foghorn.operators.rows import keep_one
from foghorn.plans.events import EVENT_KEY, enrich_strength
from foghorn.session import ensure_checkpoint_dir


def read_event_stream(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Files landing in a folder as an event stream."""
    return spark.readStream.schema(schema).parquet(folder)


def dedupe_stream(
    events: DataFrame, keys: Sequence[str] = EVENT_KEY, ts: str = "ts", late: str | None = "7 days"
) -> DataFrame:
    """First arrival per key; state for a key is dropped once the watermark passes it.

    Rows behind the watermark are lost. With ``late=None`` none is, and every key stays in the state.
    To keep the last arrival instead, as the batch append does, pass the stream with its keys to
    :func:`run_available`, which needs neither.
    """
    if late is None:
        return events.dropDuplicates(list(keys))
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def volume_stream(
    events: DataFrame, by: str, width: str = "30 days", late: str | None = "1 day", ts: str = "ts"
) -> DataFrame:
    """Events and strength per tumbling window and key.

    Rows behind the watermark are dropped; with ``late=None`` every row counts and the state holds
    one row per window and key, as the result does.
    """
    timed = events if late is None else events.withWatermark(ts, late)
    return (
        timed.groupBy(F.window(ts, width), by)
        .agg(F.count(F.lit(1)).alias("total_signals"), F.sum("signal_strength").alias("total_strength"))
        .select(F.col("window.start").alias("window_start"), by, "total_signals", "total_strength")
    )


def enrich_stream(
    news: DataFrame, include: Sequence[str], exclude: Sequence[str], valence: dict[str, float]
) -> DataFrame:
    """Stateless enrichment of a news stream, the same plan as in batch."""
    text = F.concat_ws(" ", "title", "text_snippet")
    base = F.coalesce(F.col("signal_strength"), F.lit(0.5))
    return enrich_strength(news, text, include, exclude, valence, base)


def with_dimension(events: DataFrame, companies: DataFrame, key: str = "company_id") -> DataFrame:
    """Stream-static join with the company table."""
    return events.join(companies, key, "left")


class BatchFolders:
    """Folders of micro-batches, merged by level as in a log-structured table.

    A folder ``batches=<first>-<last>`` holds the newest row per key of a range of batches. As soon as
    ``every`` folders of one size stand side by side they are merged into one, so a state of n batches is
    some ``every * log n`` folders and a row is rewritten ``log n`` times. A merged folder comes into
    place by a rename, and folders inside the range of another don't count, so a writer may stop anywhere.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], every: int = 8):
        self.spark, self.path, self.keys, self.every = spark, path.rstrip("/"), list(keys), every
        jvm = spark.sparkContext._jvm
        self.at = lambda name="": jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        self.fs = self.at().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def ranges(self) -> list[tuple[int, int]]:
        """First and last batch of the folders that count, in order."""
        if not self.fs.exists(self.at()):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(self.at())]
        found = sorted(tuple(map(int, n[8:].split("-"))) for n in names if n.startswith("batches="))
        return [r for r in found if not any(o != r and o[0] <= r[0] and r[1] <= o[1] for o in found)]

    @staticmethod
    def name(first: int, last: int) -> str:
        return f"batches={first:012d}-{last:012d}"

    def rows(self, ranges: Sequence[tuple[int, int]]) -> DataFrame:
        """The newest row per key, with its batch."""
        rows = self.spark.read.parquet(*[f"{self.path}/{self.name(*r)}" for r in ranges])
        rest = [c for c in rows.columns if c not in (*self.keys, "_batch")]
        return keep_one(rows, self.keys, [F.col("_batch").desc()] + [F.col(c).desc() for c in rest])

    def put(self, batch: DataFrame, batch_id: int) -> None:
        """Write a batch, in place of an earlier try, unless it has been merged already."""
        if any(first < last and first <= batch_id <= last for first, last in self.ranges()):
            return
        rows = batch.withColumn("_batch", F.lit(batch_id).cast("bigint"))
        rows.write.mode("overwrite").parquet(f"{self.path}/{self.name(batch_id, batch_id)}")
        self.merge()

    def merge(self) -> None:
        while True:
            ranges = self.ranges()
            size = lambda r: r[1] - r[0] + 1
            run = [r for r in ranges if ranges and size(r) == size(ranges[-1])][-self.every :]
            if len(run) < self.every or ranges[-self.every :] != run:
                return
            name = self.name(run[0][0], run[-1][1])
            self.rows(run).write.mode("overwrite").parquet(f"{self.path}/_{name}")
            self.fs.rename(self.at(f"_{name}"), self.at(name))
            for r in run:
                self.fs.delete(self.at(self.name(*r)), True)


def keep_last_writer(path: str, keys: Sequence[str] = EVENT_KEY, every: int = 8) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps the newest row per key, see :class:`BatchFolders`.

    A replayed batch replaces its own output; :func:`read_last` shows the state.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        BatchFolders(batch.sparkSession, path, keys, every).put(batch, batch_id)

    return write


def read_last(spark: SparkSession, path: str, keys: Sequence[str] = EVENT_KEY) -> DataFrame:
    """Current state of a table written by :func:`keep_last_writer`."""
    folders = BatchFolders(spark, path, keys)
    return folders.rows(folders.ranges()).drop("_batch")


def run_available(
    stream: DataFrame, name: str, keys: Sequence[str] | None = None, every: int = 8
) -> DataFrame:
    """Process everything there is and return the result table, kept on shared storage.

    Without ``keys`` the stream appends. With ``keys`` it runs in update mode:
    the newest row per key is the result, so late updates and replayed batches
    replace earlier ones. Every ``every`` batches are merged.
    """
    spark = stream.sparkSession
    base = f"{ensure_checkpoint_dir(spark)}/stream-{name}"
    writer = stream.writeStream.option("checkpointLocation", f"{base}/state").trigger(availableNow=True)
    if keys is None:
        writer.format("parquet").option("path", f"{base}/out").start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{base}/out")
    write = keep_last_writer(f"{base}/out", keys, every)
    writer.outputMode("update").foreachBatch(write).start().awaitTermination()
    return read_last(spark, f"{base}/out", keys)
