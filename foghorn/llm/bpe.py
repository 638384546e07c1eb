"""Byte-pair encoding with word ends, by contiguous rank arrays.

A word is held as the array of its parts and the array of the ranks of adjacent parts. The smallest
rank is found by scanning, the boundary there is deleted, and the two neighbouring ranks are looked
up again, until no adjacent pair has a rank. Words of equal length form a matrix, so one scan serves
thousands of words: every row that still merges loses exactly one boundary in each round. Each
distinct word of a slice of texts is encoded once. Words over ``LONG`` bytes, where scanning would
grow with the square of the length, take the same merges in the same order from a heap.

The vocabulary file is read by the driver and broadcast (its size does not depend on the data).
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from foghorn.llm.common import Shipped, slices, text_of

NO_RANK = np.int32(2**31 - 1)
LONG = 192
SLICE_CHARS = 2_000_000
CACHED_WORDS = 400_000


class Vocabulary:
    """Tables of a word-end BPE file: tokens, byte parts, and ranked pairs in a hash table."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix"):
            raise ValueError(f"{path}: not a BPE vocabulary with word ends")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [b""] * size
        for token, i in (vocab | self.special).items():
            self.tokens[i] = token.encode()
        letters = byte_letters()
        inner = np.array([vocab[c] for c in letters], np.int32)
        last = np.array([vocab[c + end] for c in letters], np.int32)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.slot_bits = int(np.ceil(np.log2(len(merges)))) + 4
        self.keys, self.ranks, self.probes = self._table(left << 32 | right)
        self.base = base = np.concatenate([inner, last])
        a, b = np.meshgrid(np.arange(512), np.arange(512), indexing="ij")
        self.byte_ranks = self.rank(base[a.ravel()], base[b.ravel()]).reshape(512, 512)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.slot_bits)).astype(np.int64)

    def _table(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Open addressing; also the longest run of slots that a look-up may have to walk."""
        slots = 1 << self.slot_bits
        keys, ranks = np.full(slots + 64, -1, np.int64), np.full(slots + 64, NO_RANK, np.int32)
        most = 0
        for rank, (pair, at) in enumerate(zip(pairs.tolist(), self._slots(pairs).tolist(), strict=True)):
            steps = 0
            while keys[at] >= 0 and keys[at] != pair:
                at, steps = at + 1, steps + 1
            if keys[at] < 0:
                keys[at], ranks[at] = pair, rank
            most = max(most, steps)
        return keys, ranks, most

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each adjacent pair; NO_RANK where the pair does not merge."""
        pairs = left.astype(np.int64) << 32 | right
        at = self._slots(pairs)
        out = np.where(self.keys[at] == pairs, self.ranks[at], NO_RANK)
        for step in range(1, self.probes + 1):
            open_ = np.flatnonzero((out == NO_RANK) & (self.keys[at + (step - 1)] >= 0))
            if not len(open_):
                break
            here = at[open_] + step
            hit = self.keys[here] == pairs[open_]
            out[open_[hit]] = self.ranks[here[hit]]
        return out


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    at = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [at[b] for b in range(256)]


def merge_block(vocabulary: Vocabulary, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, their final parts) of words of one length, as rounds finish them.

    ``codes`` are the words' bytes, the last one raised by 256; ranks of byte pairs come from a
    dense table, those of longer parts from the hash table.
    """
    rows = np.arange(len(codes))
    n = codes.shape[1]
    parts = vocabulary.base[codes]
    ranks = vocabulary.byte_ranks[codes[:, :-1], codes[:, 1:]]
    while True:
        if n == 1:
            yield rows, parts
            return
        best = ranks.argmin(axis=1)
        low = ranks[np.arange(len(rows)), best]
        done = low == NO_RANK
        if done.any():
            yield rows[done], parts[done]
            go = ~done
            rows, parts, ranks, best, low = rows[go], parts[go], ranks[go], best[go], low[go]
            if not len(rows):
                return
        each = np.arange(len(rows))
        columns = np.arange(n - 1, dtype=np.int32)
        new = vocabulary.merged[low]
        parts = np.where(columns <= best[:, None], parts[:, :-1], parts[:, 1:])
        parts[each, best] = new
        ranks = np.where(columns[:-1] < best[:, None], ranks[:, :-1], ranks[:, 1:])
        n -= 1
        has_left = np.flatnonzero(best > 0)
        ranks[has_left, best[has_left] - 1] = vocabulary.rank(
            parts[has_left, best[has_left] - 1], new[has_left]
        )
        has_right = np.flatnonzero(best < n - 1)
        ranks[has_right, best[has_right]] = vocabulary.rank(
            new[has_right], parts[has_right, best[has_right] + 1]
        )


def merge_long(vocabulary: Vocabulary, parts: list[int]) -> list[int]:
    """The same merges for one long word: a heap of (rank, place) over linked parts."""
    n = len(parts)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n

    def rank(a: int, b: int) -> int:
        return int(vocabulary.rank(np.array([parts[a]]), np.array([parts[b]]))[0])

    first = vocabulary.rank(np.array(parts[:-1], np.int32), np.array(parts[1:], np.int32)).tolist()
    heap = [(r, i, parts[i], parts[i + 1]) for i, r in enumerate(first) if r != NO_RANK]
    heapq.heapify(heap)
    while heap:
        r, i, a, b = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or parts[i] != a or parts[j] != b:
            continue
        parts[i], alive[j] = int(vocabulary.merged[r]), False
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y < n and (s := rank(x, y)) != NO_RANK:
                heapq.heappush(heap, (s, x, parts[x], parts[y]))
    return [p for p, on in zip(parts, alive, strict=True) if on]


def encode_rows(
    vocabulary: Vocabulary, sizes: np.ndarray, codes_of
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in one array, and how many each word has.

    ``sizes`` are the words' lengths in bytes; ``codes_of(members, size)`` gives the bytes of the
    words of one length as a matrix.
    """
    counts = np.zeros(len(sizes), np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    order = np.argsort(sizes, kind="stable")
    for size, begin, n in zip(*np.unique(sizes[order], return_index=True, return_counts=True), strict=True):
        members = order[begin : begin + n]
        codes = codes_of(members, int(size)).astype(np.int32)
        codes[:, -1] += 256
        if size > LONG:
            done = [
                (members[i : i + 1], np.array([merge_long(vocabulary, row.tolist())], np.int32))
                for i, row in enumerate(vocabulary.base[codes])
            ]
        else:
            step = max(1, 400_000 // int(size))
            done = [
                (members[at + rows], ids)
                for at in range(0, len(members), step)
                for rows, ids in merge_block(vocabulary, codes[at : at + step])
            ]
        for rows, ids in done:
            counts[rows] = ids.shape[1]
            found.append((rows, ids))
    starts = np.cumsum(counts) - counts
    flat = np.empty(int(counts.sum()), np.int32)
    for rows, ids in found:
        flat[(starts[rows][:, None] + np.arange(ids.shape[1])).ravel()] = ids.ravel()
    return flat, counts


def expand(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ranges flat[start : start + count] one after another."""
    before = np.cumsum(counts) - counts
    return flat[np.repeat(starts - before, counts) + np.arange(int(counts.sum()))]


#: Unicode white space, and how the vocabulary's text is cut into words.
WHITE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
RARE_WHITE = r"[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
MARKS = b",.;:!?"
SHORT = 24  # bytes of a word that fit the three integers of its key


class WordTable:
    """Numbers of short words, found for a whole slice of text at once.

    Open addressing over arrays, which grow before more than half of the slots are taken. A key is
    the word's bytes themselves in three integers, so equal keys are equal words.
    """

    def __init__(self, bits: int):
        self.bits, self.held = bits, 0
        self.keys = np.zeros((3, 1 << bits), np.uint64)
        self.number = np.full(1 << bits, -1, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys[0] * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed += keys[1] * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(31)
        mixed += keys[2] * np.uint64(0x165667B19E3779F9)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for unknown ones."""
        last = (1 << self.bits) - 1
        slots = self._slots(keys)
        out = self.number[slots]
        open_ = np.flatnonzero(out >= 0)
        open_ = open_[(self.keys[:, slots[open_]] != keys[:, open_]).any(axis=0)]
        while len(open_):
            slots[open_] = (slots[open_] + 1) & last
            out[open_] = self.number[slots[open_]]
            open_ = open_[out[open_] >= 0]
            open_ = open_[(self.keys[:, slots[open_]] != keys[:, open_]).any(axis=0)]
        return out

    def add(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Enter keys that are distinct and not in the table."""
        if 2 * (self.held + keys.shape[1]) > 1 << self.bits:
            taken = np.flatnonzero(self.number >= 0)
            keys = np.concatenate([self.keys[:, taken], keys], axis=1)
            numbers = np.concatenate([self.number[taken], numbers])
            self.__init__((2 * keys.shape[1]).bit_length())
        self.held += keys.shape[1]
        last = (1 << self.bits) - 1
        slots, rest = self._slots(keys), np.arange(keys.shape[1])
        while len(rest):
            free = rest[self.number[slots[rest]] < 0]
            taken, first = np.unique(slots[free], return_index=True)
            winners = free[first]
            self.number[taken] = numbers[winners]
            self.keys[:, taken] = keys[:, winners]
            placed = np.zeros(keys.shape[1], bool)
            placed[winners] = True
            rest = rest[~placed[rest]]
            slots[rest] = (slots[rest] + 1) & last


class Encoder:
    """Encodes texts; keeps the ids of the words seen, up to CACHED_WORDS, as long as a task runs."""

    TABLE_BITS = 20

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.white = regex.compile(WHITE)
        self.rare_white = regex.compile(RARE_WHITE)
        # classes and cases of rarer letters follow the library's version of Unicode
        self.words = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)
        self.case = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.rare = regex.compile("[\u0250-\u1fff\u2070-\U0010ffff]")
        self.special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")")
        space = np.zeros(256, bool)
        space[[9, 10, 11, 12, 13, 32]] = True
        self.space = space
        self.letter = np.zeros(256, bool)
        self.letter[[0, *range(97, 123), 0xC3]] = True
        self.second = np.zeros(256, bool)  # after 0xC3: the small Latin-1 letters
        self.second[[0x9F, *range(0xA0, 0xC0)]] = True
        self.second[0xB7] = False
        self.mark = np.zeros(256, bool)
        self.mark_number = np.zeros(256, np.int64)
        for i, m in enumerate(MARKS):
            self.mark[m], self.mark_number[m] = True, i
        self.masks = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
        self.forget()

    def forget(self) -> None:
        self.table = WordTable(self.TABLE_BITS)
        self.others: dict[bytes, int] = {}
        self.flat = np.empty(0, np.int32)
        self.starts = self.counts = np.empty(0, np.int64)

    def all_letters(self, words: np.ndarray) -> np.ndarray:
        """Whether a word, padded with zeros, is made of a-z and small Latin-1 letters only."""
        after = np.zeros(words.shape, bool)
        after[:, 1:] = words[:, :-1] == 0xC3
        return np.where(after, self.second[words], self.letter[words]).all(axis=1)

    def plain(self, text: str) -> bytes:
        """The normalised text: words in UTF-8 with ASCII white space between.

        A special token becomes a word of its own that starts with a byte no UTF-8 text has.
        """
        if "<|" in text:
            parts = self.special.split(text)
            return b" ".join(
                b"\xff" + part.encode() if i % 2 else self.plain_segment(part)
                for i, part in enumerate(parts)
            )
        return self.plain_segment(text)

    def plain_segment(self, text: str) -> bytes:
        if not text.isascii():
            text = self.rare_white.sub(" ", text)
            if self.rare.search(text):
                return self.case.normalize_str(text).encode()
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
        return text.lower().encode()

    def numbers(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Start and number of each word of ``data``, learning the new ones."""
        codes = np.frombuffer(data + b" " * 32, np.uint8)
        inside = np.concatenate([[False], ~self.space[codes]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, sizes = edges[::2], edges[1::2] - edges[::2]
        eights = np.ndarray((len(codes) - 7,), "<u8", codes, strides=(1,))
        keys = np.stack(
            [eights[np.minimum(starts + at, len(eights) - 1)] & self.masks[np.clip(sizes - at, 0, 8)] for at in (0, 8, 16)]
        )
        odd = sizes > SHORT
        if b"\0" in data:  # the key of a short word is padded with zeros
            zeros = np.cumsum(np.concatenate([[0], codes == 0]))
            odd |= zeros[starts + sizes] > zeros[starts]
        number = self.table.find(keys)
        number[odd] = -1
        missing = np.flatnonzero((number < 0) & ~odd)
        odd = np.flatnonzero(odd)
        fresh: list[bytes] = []
        known = len(self.starts)
        for i in odd.tolist():
            word = data[starts[i] : starts[i] + sizes[i]]
            if word not in self.others:
                self.others[word] = known + len(fresh)
                fresh.append(word)
            number[i] = self.others[word]
        short = np.empty((3, 0), np.uint64)
        if len(missing):
            order = missing[np.lexsort(keys[:, missing])]
            new = np.concatenate([[True], (keys[:, order[1:]] != keys[:, order[:-1]]).any(axis=0)])
            short = keys[:, order[new]]
            numbers = (known + len(fresh) + np.arange(short.shape[1])).astype(np.int32)
            number[order] = numbers[np.cumsum(new) - 1]
            self.table.add(short, numbers)
            short_sizes = sizes[order[new]]
        if fresh or short.shape[1]:
            self.learn(fresh, short, short_sizes if short.shape[1] else np.empty(0, np.int64))
        return starts, number

    def learn(self, others: list[bytes], short: np.ndarray, short_sizes: np.ndarray) -> None:
        """Encode new runs: ``others`` as bytes, then short ones by their keys."""
        matrix = np.ascontiguousarray(short.T).astype("<u8").view(np.uint8).reshape(-1, SHORT)
        each = np.arange(len(matrix))
        last_byte = matrix[each, short_sizes - 1]
        cut = self.mark[last_byte] & (short_sizes > 1)  # a word with a mark after it
        heads, sizes = matrix.copy(), short_sizes - cut
        heads[each[cut], sizes[cut]] = 0
        letters = self.all_letters(heads)
        cut &= letters
        owners = np.ones(len(others) + len(matrix), np.int64)  # how many words each run has
        owners[len(others) + np.flatnonzero(cut)] = 2
        words: dict[bytes, int] = {bytes([m]): i for i, m in enumerate(MARKS)}
        mixed: list[int] = []
        special: dict[int, int] = {}
        rows = matrix.tobytes()
        rest = np.flatnonzero(~letters)
        runs = others + [
            rows[i * SHORT : i * SHORT + n]
            for i, n in zip(rest.tolist(), short_sizes[rest].tolist(), strict=True)
        ]
        places = np.concatenate([np.arange(len(others)), rest + len(others)]).astype(np.int64)
        for i, run in zip(places.tolist(), runs, strict=True):
            if run[0] == 255:
                special[i] = self.vocabulary.special[run[1:].decode()]
                owners[i] = 0
                continue
            found = [w for w, _ in self.words.pre_tokenize_str(run.decode())]
            owners[i] = len(found)
            for word in found:
                mixed.append(words.setdefault(word.encode(), len(words)))
        plain = np.flatnonzero(letters)
        strings = list(words)
        sizes = np.concatenate([sizes[plain], np.fromiter(map(len, strings), np.int64, len(strings))])

        def codes_of(members: np.ndarray, size: int) -> np.ndarray:
            own = members[members < len(plain)]
            rest = members[members >= len(plain)] - len(plain)
            joined = np.frombuffer(b"".join([strings[i] for i in rest.tolist()]), np.uint8)
            short = heads[plain[own], :size] if size <= SHORT else np.empty((0, size), np.uint8)
            return np.concatenate([short, joined.reshape(-1, size)])

        flat, counts = encode_rows(self.vocabulary, sizes, codes_of)
        pieces = np.empty(int(owners.sum()), np.int64)
        first = np.cumsum(owners) - owners
        pieces[first[len(others) + plain]] = np.arange(len(plain))
        marked = np.flatnonzero(cut)
        pieces[first[len(others) + marked] + 1] = self.mark_number[last_byte[marked]] + len(plain)
        by_rule = np.zeros(len(owners), bool)
        by_rule[places] = True
        pieces[np.repeat(by_rule, owners)] = np.array(mixed, np.int64) + len(plain)
        starts = np.cumsum(counts) - counts
        ids = expand(flat, starts[pieces], counts[pieces])
        ends = np.cumsum(np.concatenate([[0], counts[pieces]]))
        last = np.cumsum(owners)
        begins = ends[last - owners]
        sizes = ends[last] - begins
        if special:
            at = np.fromiter(special, np.int64)
            sizes[at], begins[at] = 1, len(ids) + np.arange(len(at))
            ids = np.concatenate([ids, np.fromiter(special.values(), np.int32)])
        self.starts = np.concatenate([self.starts, begins + len(self.flat)])
        self.counts = np.concatenate([self.counts, sizes])
        self.flat = np.concatenate([self.flat, ids])

    def encode(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        """The ids of each text in turn."""
        for begin, end in slices(texts, SLICE_CHARS):
            plain = [self.plain(t) for t in texts[begin:end]]
            if len(plain) == 1 and len(plain[0]) > 4 * SLICE_CHARS:
                yield np.concatenate([ids for part in parts_of(plain[0]) for ids in self.slice_ids([part])])
            else:
                yield from self.slice_ids(plain)

    def slice_ids(self, plain: list[bytes]) -> Iterator[np.ndarray]:
        """The ids of each of a few normalised texts, which are looked up together."""
        if len(self.starts) > CACHED_WORDS:
            self.forget()
        starts, number = self.numbers(b"\n".join(plain))
        counts = self.counts[number]
        ids = expand(self.flat, self.starts[number], counts)
        ends = np.cumsum([len(p) + 1 for p in plain])
        at = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, ends)]
        begin = 0
        for end in at.tolist():
            yield ids[begin:end]
            begin = end


def parts_of(data: bytes) -> Iterator[bytes]:
    """A very long normalised text in parts that end at a line end or space, where there is one."""
    begin = 0
    while begin < len(data):
        cut = begin + SLICE_CHARS
        spaces = [i for i in (data.find(b" ", cut), data.find(b"\n", cut)) if i >= 0]
        end = min(spaces) + 1 if spaces else len(data)
        yield data[begin:end]
        begin = end


def decode(vocabulary: Vocabulary, ids: np.ndarray) -> bytes:
    """The tokens' strings with a space between, which is how this vocabulary decodes."""
    return b" ".join(map(vocabulary.tokens.__getitem__, ids.tolist()))


def encode_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its id and ``ids``, the array of token ids.

    Null and empty texts have no ids; equal texts and repeated rows are encoded alike; other columns
    of the input are dropped, whatever their names.
    """
    vocabulary = Shipped(docs.sparkSession, Vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.get())
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for begin, end in slices(texts, SLICE_CHARS):
                ids = [x.astype(np.int32) for x in encoder.encode(texts[begin:end])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, end - begin), pa.array(ids, pa.list_(pa.int32()))],
                    ["doc_id", "ids"],
                )

    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(
        run, "doc_id bigint, ids array<int>"
    )


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and the decoded ``text`` of frames that ``encode_documents`` made."""
    vocabulary = Shipped(encoded.sparkSession, Vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary.get()
        for batch in batches:
            texts = [
                decode(own, np.array(ids or [], np.int64)).decode() for ids in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def round_trip_digests(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode and decode every text in one pass; return counts and digests of both directions.

    Null counts as the empty text, whose id list and decoded text are empty. Rows with equal texts
    get equal digests. One row per row of the input; other columns are dropped.
    """
    vocabulary = Shipped(docs.sparkSession, Vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.get())
        for batch in batches:
            sizes, digests, decoded = [], [], []
            for ids in encoder.encode(batch.column(1).to_pylist()):
                sizes.append(len(ids))
                digests.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(decode(encoder.vocabulary, ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
