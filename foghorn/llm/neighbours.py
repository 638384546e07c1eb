"""Quality by nearest-neighbour voting in a latent space.

The terms of a text are runs of word shapes: classes of characters (small and capital letters,
digits, white space, each mark) with repeated ones taken once, read three and four at a time, and
two terms for repetition (words equal to the one before, lines that occurred before). Term weights
are logarithmic counts times inverse document frequency; the leading singular directions of the
labelled sample span the latent space. The labelled vectors, whose number is bounded, are broadcast;
each task compares its documents with all of them, a block at a time, by one matrix product, and the
nearest vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foghorn.llm.common import Shipped, bounded_sample, held_out, map_batches, one_text_each, text_of


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled rows learnt from, and with them what is broadcast."""

    sample_rows: int = 6_000
    buckets: int = 2048
    dimensions: int = 48
    neighbours: int = 25
    sharpness: float = 8.0
    block: int = 256
    seed: int = 11


def byte_classes() -> np.ndarray:
    """A class for each byte: small letters with all of UTF-8's upper half, capitals, digits, spaces, marks."""
    classes = np.arange(256, dtype=np.uint8)
    classes[ord("a") : ord("z") + 1] = ord("a")
    classes[128:] = ord("a")
    classes[ord("A") : ord("Z") + 1] = ord("A")
    classes[ord("0") : ord("9") + 1] = ord("0")
    classes[[9, 11, 12, 13]] = ord(" ")
    return classes


def term_counts(text: str, settings: Settings, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the whole text's terms and their counts. The last two buckets are for repetition."""
    shape = classes[np.frombuffer(text.encode(), np.uint8)]
    if not len(shape):
        return np.empty(0, np.int64), np.empty(0)
    shape = shape[np.concatenate([[True], shape[1:] != shape[:-1]])].astype(np.uint32)
    runs = []
    for n in (3, 4):
        code = np.full(max(len(shape) - n + 1, 0), n, np.uint32)
        for i in range(n):
            code = code * np.uint32(0x01000193) ^ shape[i : i + len(code)]
        runs.append((code * np.uint32(0x9E3779B1)) >> np.uint32(8))
    places = np.concatenate(runs).astype(np.int64) % (settings.buckets - 2)
    counts = np.bincount(places, minlength=settings.buckets).astype(float)
    words = text.split()
    counts[-1] = sum(map(eq, words, words[1:]))
    lines = [x for x in text.split("\n") if x]
    counts[-2] = len(lines) - len(set(lines))
    found = np.flatnonzero(counts)
    return found, counts[found]


class Voters:
    """The latent space and the labelled vectors in it."""

    def __init__(self, settings: Settings):
        self.settings = settings
        self.classes = byte_classes()
        self.prior = 0.5
        self.project: np.ndarray | None = None

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> "Voters":
        s, n = self.settings, len(rows)
        if not n:
            return self
        self.prior = float(labels.mean())
        seen = np.bincount(np.concatenate([ids for ids, _ in rows]), minlength=s.buckets)
        self.idf = (np.log((n + 1) / (seen + 1)) + 1).astype(np.float32)
        data = np.zeros((n, s.buckets), np.float32)
        for row, (ids, counts) in zip(data, rows, strict=True):
            row[ids] = self._weights(ids, counts)
        # leading right singular vectors by a few power steps from a fixed random start
        rng = np.random.default_rng(s.seed)
        k = min(s.dimensions, n, s.buckets)
        basis = rng.normal(size=(s.buckets, k + 8)).astype(np.float32)
        for _ in range(4):
            basis = np.linalg.qr(data.T @ (data @ basis))[0]
        _, _, turn = np.linalg.svd(data @ basis, full_matrices=False)
        self.project = np.ascontiguousarray((basis @ turn.T)[:, :k], np.float32)
        vectors, ok = self._unit(data @ self.project)
        self.vectors, self.labels = np.ascontiguousarray(vectors[ok].T), labels[ok].astype(np.float32)
        return self

    def _weights(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = np.log1p(counts) * self.idf[ids]
        return weights / (np.sqrt((weights * weights).sum()) or 1)

    @staticmethod
    def _unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
        return vectors / np.maximum(norms, 1e-9), norms[:, 0] > 1e-9

    def score(self, texts: list[str]) -> np.ndarray:
        """Share of label 1 among the nearest, weighted; the prior for texts without terms."""
        out = np.full(len(texts), self.prior)
        if self.project is None or not len(self.labels):
            return out
        s = self.settings
        near = min(s.neighbours, len(self.labels))
        for at in range(0, len(texts), s.block):
            part = texts[at : at + s.block]
            latent = np.zeros((len(part), self.project.shape[1]), np.float32)
            for i, text in enumerate(part):
                ids, counts = term_counts(text, s, self.classes)
                if len(ids):
                    latent[i] = self._weights(ids, counts).astype(np.float32) @ self.project[ids]
            latent, ok = self._unit(latent)
            cosine = latent @ self.vectors  # exact, against every labelled vector
            best = np.argpartition(-cosine, near - 1, axis=1)[:, :near]
            weight = np.maximum(np.take_along_axis(cosine, best, 1), 1e-3).astype(float) ** s.sharpness
            votes = (weight * self.labels[best]).sum(axis=1) / weight.sum(axis=1)
            out[at : at + s.block] = np.where(ok, votes, self.prior)
        return np.clip(out, 0, 1)


def train(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    fold: tuple[int, int] = (4, 2),
) -> Voters:
    """Learn from at most ``sample_rows`` labelled rows outside the held-out fold (count, number).

    Only term counts of these rows reach the driver. Rows without a label or an id are left out;
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
        classes = byte_classes()
        found = [term_counts(t, settings, classes) for t in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([i.astype(np.int32) for i, _ in found], pa.list_(pa.int32())),
                pa.array([c.astype(np.float32) for _, c in found], pa.list_(pa.float32())),
            ],
            ["_id", "label", "ids", "counts"],
        )

    found = map_batches(rows, terms, "_id bigint, label int, ids array<int>, counts array<float>").toArrow()
    order = np.argsort(found.column("_id").to_numpy(), kind="stable")
    ids, counts = (found.column(c).combine_chunks() for c in ("ids", "counts"))
    at, ids, counts = ids.offsets.to_numpy(), ids.values.to_numpy(), counts.values.to_numpy()
    rows_of = [(ids[at[i] : at[i + 1]].astype(np.int64), counts[at[i] : at[i + 1]].astype(float)) for i in order]
    return Voters(settings).fit(rows_of, found.column("label").to_numpy()[order].astype(np.float32))


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    threshold: float = 0.7,
    id_col: str = "doc_id",
    text_col: str = "text",
    fold: tuple[int, int] = (4, 2),
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted.

    A null or empty text, like one whose terms the sample never had, gets the share of label 1 in the
    sample; equal texts get equal scores. Without labelled rows every text gets one half. A row without
    an id is not held out. An empty table gives no rows; other columns are dropped.
    """
    voters = Shipped(docs.sparkSession, train(docs, labels, settings, id_col=id_col, text_col=text_col, fold=fold))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = voters.get()
        for texts in batches:
            yield pd.Series(own.score(texts.tolist()), dtype="float64")

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return rows.select("doc_id", score("text").alias("score")).select(
        "doc_id",
        held_out(F.col("doc_id"), *fold).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
