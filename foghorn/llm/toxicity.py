"""Toxicity by a factorisation machine over hashed terms.

A text is the set of its words, lower case, and of their beginnings, hashed to buckets. The machine adds a bias, a weight per
bucket present, and for every pair of them the product of two short factor vectors, so that a pair
can count for more, or less, than its parts. It is trained by the driver on the terms of a bounded
sample of labelled rows; the buckets that tell the labels apart best are selected first. The model
has a fixed size, is broadcast, and scores all texts in one pass without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foghorn.llm.common import Shipped, bounded_sample, held_out, map_batches, one_text_each, text_of


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled rows learnt from; the rest shapes the model."""

    sample_rows: int = 12_000
    bits: int = 20
    stems: tuple[int, ...] = (3, 4, 5, 7)  # lengths of the beginnings that count as terms
    selected: int = 512
    least_rows: int = 6  # a bucket must occur in that many rows of the sample
    factors: int = 8
    epochs: int = 25
    batch: int = 256
    rate: float = 0.02
    weight_decay: float = 1e-3
    seed: int = 7


WORD = re.compile(r"[^\W\d_]+")


def buckets(text: str, settings: Settings) -> np.ndarray:
    """The distinct buckets of the words of the whole text and of their beginnings."""
    words = set(WORD.findall(text.lower()))
    terms = words.union(*[{w[:n] for w in words} for n in settings.stems])
    shift = 32 - settings.bits
    found = {zlib.crc32(t.encode()) >> shift for t in terms}
    return np.fromiter(found, np.int64, len(found))


class Machine:
    """Selected buckets, their weights and factors, and the bias."""

    def __init__(self, settings: Settings):
        self.settings = settings
        self.place = np.full(1 << settings.bits, -1, np.int16)
        self.bias, self.weights = 0.0, np.zeros(settings.selected, np.float32)
        self.factors = np.zeros((settings.selected, settings.factors), np.float32)

    def select(self, rows: list[np.ndarray], labels: np.ndarray) -> None:
        """Take the buckets whose presence differs most between the labels (chi-square)."""
        size = 1 << self.settings.bits
        ids = np.concatenate([*rows, np.empty(0, np.int64)])
        of = np.repeat(labels, [len(r) for r in rows])
        all_, ones = np.bincount(ids, minlength=size), np.bincount(ids, weights=of, minlength=size)
        total, positive = max(len(labels), 1), float(labels.sum())
        expected = all_ * positive / total
        with np.errstate(divide="ignore", invalid="ignore"):
            chi = (ones - expected) ** 2 / (expected * (1 - all_ / (total + 1)))
        chi[(all_ < self.settings.least_rows) | ~np.isfinite(chi)] = -1
        best = np.lexsort((np.arange(size), -chi))[: self.settings.selected]
        best = np.sort(best[chi[best] > 0])
        self.place[best] = np.arange(len(best))

    def known(self, ids: np.ndarray) -> np.ndarray:
        at = self.place[ids]
        return at[at >= 0].astype(np.int64)

    def fit(self, rows: list[np.ndarray], labels: np.ndarray) -> "Machine":
        """Minimise the log loss by Adam over shuffled batches; without both labels, the prior alone."""
        s, n = self.settings, len(labels)
        share = (float(labels.sum()) + 0.5) / (n + 1)
        self.bias = float(np.log(share / (1 - share)))
        if not n or labels.min() == labels.max():
            return self
        self.select(rows, labels)
        rng = np.random.default_rng(s.seed)
        self.factors = rng.normal(0, 0.05, self.factors.shape).astype(np.float32)
        rows = [self.known(r) for r in rows]
        params = [np.array([self.bias], np.float32), self.weights, self.factors]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        step = 0
        for _ in range(s.epochs):
            order = rng.permutation(n)
            for at in range(0, n, s.batch):
                take = order[at : at + s.batch]
                gradients = self._gradients([rows[i] for i in take], labels[take])
                step += 1
                for p, g, (m, v) in zip(params, gradients, moments, strict=True):
                    if p is not params[0]:
                        g = g + s.weight_decay * p
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= s.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                self.bias = float(params[0][0])
        return self

    def _sums(self, rows: list[np.ndarray]):
        sizes = np.array([len(r) for r in rows])
        ids = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
        of = np.repeat(np.arange(len(rows)), sizes)
        v = self.factors[ids]
        total = np.zeros((len(rows), self.factors.shape[1]), np.float32)
        np.add.at(total, of, v)
        linear = np.bincount(of, weights=self.weights[ids], minlength=len(rows))
        squares = np.bincount(of, weights=(v * v).sum(axis=1), minlength=len(rows))
        return ids, of, v, total, self.bias + linear + 0.5 * ((total * total).sum(axis=1) - squares)

    def _gradients(self, rows: list[np.ndarray], labels: np.ndarray) -> list[np.ndarray]:
        ids, of, v, total, logit = self._sums(rows)
        error = ((_sigmoid(logit) - labels) / len(rows)).astype(np.float32)
        linear = np.bincount(ids, weights=error[of], minlength=len(self.weights)).astype(np.float32)
        pairs = np.zeros_like(self.factors)
        np.add.at(pairs, ids, error[of, None] * (total[of] - v))
        return [np.array([error.sum()], np.float32), linear, pairs]

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        return _sigmoid(self._sums([self.known(r) for r in rows])[-1])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    fold: tuple[int, int] = (5, 0),
) -> Machine:
    """Learn from at most ``sample_rows`` labelled rows outside the held-out fold (count, number).

    Only the bucket numbers of these rows reach the driver. Rows without a label or an id are left out;
    of several texts or labels of one id the text of smallest digest, then the smallest label, is taken.
    """
    usable = labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
    usable = usable.filter(~held_out(F.col("doc_id"), *fold)).select(
        F.col("doc_id").alias("_id"), F.col(label_col).cast("int").alias("label")
    )
    sample = bounded_sample(usable, "_id", settings.sample_rows)
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("text"))
    rows = one_text_each(rows.join(F.broadcast(sample), "_id").select("_id", "label", "text"))

    def terms(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [buckets(t, settings).astype(np.int32) for t in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["_id", "label", "terms"]
        )

    found = map_batches(rows, terms, "_id bigint, label int, terms array<int>").toArrow()
    order = np.argsort(found.column("_id").to_numpy(), kind="stable")
    column = found.column("terms").combine_chunks()
    offsets, flat = column.offsets.to_numpy(), column.values.to_numpy()
    rows_of = [np.sort(flat[offsets[i] : offsets[i + 1]]).astype(np.int64) for i in order]
    return Machine(settings).fit(rows_of, found.column("label").to_numpy()[order].astype(np.float32))


def with_score(docs: DataFrame, machine: Machine, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` as one struct ``_row``, and the ``score`` of the whole text."""
    model = Shipped(docs.sparkSession, machine)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), text_of(text_col).alias("text"))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = model.get()
        for texts in batches:
            yield pd.Series(own.score([buckets(t, own.settings) for t in texts]), dtype="float64")

    return rows.select("_row", score("text").alias("score"))


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    threshold: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    fold: tuple[int, int] = (5, 0),
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted.

    A null or empty text has no terms and gets the bias alone; texts with equal words get equal
    scores. Without labelled rows every text gets one half or the share of the label there is. A row
    without an id is not held out. An empty table gives no rows; other columns are dropped.
    """
    machine = train(docs, labels, settings, id_col=id_col, text_col=text_col, fold=fold)
    scored = with_score(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), machine)
    return scored.select(
        F.col("_row.doc_id").alias("doc_id"),
        held_out(F.col("_row.doc_id"), *fold).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_civil(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.5
) -> DataFrame:
    """The rows of ``docs`` that score under the threshold, with all their columns."""
    machine = train(docs, labels, settings)
    return with_score(docs, machine).filter(F.col("score") < threshold).select("_row.*")
