"""Helpers shared by the operators: text columns, keys of rows, batches of Arrow rows."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foghorn.operators.rows import keep_one
from foghorn.session import ensure_checkpoint_dir, spread
from foghorn.sources.tables import table

#: Words of a text: runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of documents, in at least as many partitions as the session has cores."""
    return spread(table(spark, sf_dir, "documents"))


def text_of(column: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``function(batch)`` of every Arrow batch, for work that keeps nothing between batches.

    Spark bounds a batch by rows and by bytes. The function gets a RecordBatch and returns one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(run, schema)


class Shipped:
    """A bounded driver-side object for use in Python tasks, broadcast once.

    It travels as bytes that hold its class as well, so workers need no copy of this package.
    """

    def __init__(self, spark: SparkSession, value: object):
        self._bytes = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get(self):
        return pickle.loads(self._bytes.value)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read again.

    For tables of many rows, which take a fraction of the space of a checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    folder = f"{df.sparkSession.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def slices(texts: Sequence[str], chars: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``chars`` characters each, one row at least."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= chars:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls in the fold that is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def bounded_sample(labelled: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, those of smallest key hash: a distributed take-ordered."""
    return labelled.orderBy(F.xxhash64(F.lit("sample"), F.col(key)), F.col(key)).limit(rows)


def one_text_each(rows: DataFrame) -> DataFrame:
    """One row per ``_id`` of ``_id, label, text``: that of smallest text digest, then of smallest label."""
    digest = F.sha2(F.col("text").cast("binary"), 256)
    return keep_one(rows.withColumn("_sha", digest), ["_id"], [F.col("_sha"), F.col("label")]).drop("_sha")
