"""Packing of token sequences under several limits at once: vector bin packing by dot product.

An example has a size in each dimension: tokens, segments (one) and loss-bearing tokens. The open
sequence takes, of the examples that fit, the one whose size vector has the largest dot product
with the room that is left, both as shares of the limits. When none fits and there is still room
for at least ``min_piece`` tokens, the best one is cut to fill it and its rest stays a candidate.
A partition is packed by its own task in blocks of a fixed number of examples; the open sequence
goes on from one block to the next, so what is lost per partition is at most one unfilled sequence,
which is then cut into sequences whose lengths are powers of two and need no padding. No row is
shuffled and nothing is gathered: a task holds one block of examples.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from foghorn.llm.bpe import Encoder, Vocabulary
from foghorn.llm.common import Shipped, text_of

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, loss_tokens bigint"
)


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold, and the shortest piece that filling one may cut off."""

    tokens: int = 2048
    segments: int = 64
    loss_tokens: int = 2048
    min_piece: int = 16
    block: int = 2048  # examples that a task chooses from at a time


class Packer:
    """Places the examples of one partition. ``emit`` gets each piece once its place is known.

    An example is (key, ids, loss): ``loss`` flags the ids that bear loss, or is None for all.
    """

    def __init__(self, limits: Limits, first_sequence: int):
        self.limits = limits
        self.sequence = first_sequence
        self.pieces: list[tuple] = []
        self.open: list[tuple] = []  # pieces of the sequence being filled
        self.used = np.zeros(3, np.int64)

    def _take(self, key, start: int, ids: np.ndarray, loss: np.ndarray | None) -> None:
        self.open.append((key, start, ids, loss))
        self.used += (len(ids), 1, _loss(loss, len(ids)))

    def _close(self, tokens: int | None = None) -> None:
        """Close the first ``tokens`` of the open sequence (all by default); what is cut off stays open."""
        left = int(self.used[0]) if tokens is None else tokens
        pieces, self.open, self.used = self.open, [], np.zeros(3, np.int64)
        offset = 0
        for key, start, ids, loss in pieces:
            n = min(len(ids), left)
            left -= n
            if n:
                crc = zlib.crc32(ids[:n].astype("<u4").tobytes())
                self.pieces.append((key, start, n, crc, self.sequence, offset, _loss(loss, n)))
                offset += n
            if n < len(ids):
                self._take(key, start + n, ids[n:], None if loss is None else loss[n:])
        self.sequence += 1

    def _close_power(self) -> None:
        """Close the largest power of two of the open sequence, which needs no padding."""
        self._close(1 << (int(self.used[0]).bit_length() - 1))

    @property
    def _caps(self) -> np.ndarray:
        return np.array([self.limits.tokens, self.limits.segments, self.limits.loss_tokens], np.int64)

    def add(self, examples: list[tuple]) -> None:
        """Place a block of examples.

        What is longer than a sequence is cut into full ones first; what bears more loss than one may
        is cut into parts that bear as much as it may.
        """
        caps, rest = self._caps, []
        for key, ids, loss in examples:
            start = 0
            while len(ids) >= caps[0] or _loss(loss, len(ids)) > caps[2]:
                n = _fit(loss, min(len(ids), int(caps[0])), int(caps[2]))
                head = (key, start, ids[:n], None if loss is None else loss[:n])
                if n == caps[0]:
                    held, room = (self.open, self.used), np.zeros(3, np.int64)
                    self.open, self.used = [], room
                    self._take(*head)
                    self._close()
                    self.open, self.used = held
                else:
                    rest.append(list(head))
                start, ids, loss = start + n, ids[n:], None if loss is None else loss[n:]
            if len(ids):
                rest.append([key, start, ids, loss])
        self._fill(rest)

    def _fill(self, rest: list[list]) -> None:
        caps = self._caps
        sizes = np.array(
            [(len(ids), 1, _loss(loss, len(ids))) for _, _, ids, loss in rest], np.int64
        ).reshape(-1, 3)
        weight = 1.0 / caps.astype(float) ** 2
        alive = np.ones(len(rest), bool)
        left = len(rest)
        while left:
            room = caps - self.used
            fits = alive & (sizes <= room).all(axis=1)
            score = np.where(fits, sizes @ (room * weight), -1.0)
            best = int(score.argmax())
            if score[best] < 0:
                if self._cut(rest, sizes, alive, room, weight):
                    continue
                # closed by its segments or its loss: only what needs no padding goes, the rest is filled up
                if room[0] < self.limits.min_piece:
                    self._close()
                else:
                    self._close_power()
                continue
            self._take(*rest[best])
            alive[best] = False
            left -= 1
            if self.used[0] >= caps[0]:
                self._close()

    def _cut(self, rest, sizes, alive, room, weight) -> bool:
        """Fill the room with the head of the best example that leaves a rest; False if it is too small."""
        if room[0] < self.limits.min_piece or room[1] < 1 or room[2] < 1 or not self.open:
            return False
        long = alive & (sizes[:, 0] >= room[0] + self.limits.min_piece)
        if not long.any():
            return False
        best = int(np.where(long, sizes @ (room * weight), -1.0).argmax())
        key, start, ids, loss = rest[best]
        n = _fit(loss, int(room[0]), int(room[2]))
        if n < self.limits.min_piece:
            return False
        head, tail = (None, None) if loss is None else (loss[:n], loss[n:])
        self._take(key, start, ids[:n], head)
        rest[best] = [key, start + n, ids[n:], tail]
        sizes[best] -= (n, 0, _loss(head, n))
        if self.used[0] >= self.limits.tokens:
            self._close()
        return True

    def finish(self) -> None:
        """Cut what is open into sequences of powers of two, the largest first."""
        while self.open:
            self._close_power()


def _loss(loss: np.ndarray | None, n: int) -> int:
    """Loss-bearing ids among the first ``n``."""
    return n if loss is None else int(loss[:n].sum())


def _fit(loss: np.ndarray | None, room: int, loss_room: int) -> int:
    """How many of the first ids fit both rooms."""
    if loss is None:
        return min(room, loss_room)
    return int(np.searchsorted(np.cumsum(loss[:room]), loss_room, side="right"))


def pack_examples(
    docs: DataFrame,
    vocabulary_path: str,
    limits: Limits = Limits(),
    separator: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_tokens: Column | None = None,
) -> DataFrame:
    """Encode each row's text, end it with ``separator``, and place it: one row per piece.

    ``prompt_tokens`` is the number of leading ids that bear no loss (instruction data); by default
    every id bears loss. A null or empty text is the separator alone. Equal or repeated rows are
    packed separately, and a null id is kept as it is. An empty table gives no rows. Other columns
    of the input are dropped, whatever their names. ``sequence_id`` holds the partition in its
    upper bits; the rows of a partition must come in a fixed order (a table, a checkpoint). A text
    longer than a sequence fills whole ones before its rest is placed; of examples that score alike
    the first of the block is taken. ``loss_tokens`` counts the loss-bearing ids of the very piece.
    """
    vocabulary = Shipped(docs.sparkSession, Vocabulary(vocabulary_path))
    prompt = F.lit(None) if prompt_tokens is None else prompt_tokens
    whole = prompt_tokens is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.get())
        packer = Packer(limits, TaskContext.get().partitionId() << 40)
        totals: list[int] = []
        keys: list[int | None] = []
        held: list[tuple] = []

        def flush(last: bool) -> pa.RecordBatch | None:
            packer.add(held)
            held.clear()
            if last:
                packer.finish()
            if not packer.pieces:
                return None
            no, start, length, crc, sequence, offset, loss = zip(*packer.pieces, strict=True)
            packer.pieces = []
            columns = [[keys[i] for i in no], start, length, crc, [totals[i] for i in no], sequence, offset, loss]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], [f.split()[0] for f in PIECES.split(", ")]
            )

        for batch in batches:
            prompts = batch.column(2).to_pylist()
            ids_of = encoder.encode(batch.column(1).to_pylist())
            for key, ids, n in zip(batch.column(0).to_pylist(), ids_of, prompts, strict=True):
                ids = np.append(ids, separator).astype(np.uint32)
                loss = None if whole else np.arange(len(ids)) >= (n or 0)
                held.append((len(keys), ids, loss))
                keys.append(key)
                totals.append(len(ids))
                if len(held) >= limits.block and (out := flush(False)):
                    yield out
        if out := flush(True):
            yield out

    rows = docs.select(
        F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"), prompt.cast("int").alias("prompt")
    )
    return rows.mapInArrow(run, PIECES)
