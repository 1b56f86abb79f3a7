"""Counts of a text's words, capitals, code points and symbols in one pass over its UTF-8 bytes.

The pass is a finite-state transducer given by two tables: the state behind each byte, and what is put out for a state
and the byte that follows it. As the state behind a byte does not depend on the state before, a block of bytes goes
through the tables at once, and only the state, with the word left open, is carried from block to block. The spans of
words that come out go into a hash table with open addressing; a span counts as known only after its bytes
were compared, so two words with one hash are two words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from panelkit.llm.batches import lots

# White space between words, and the symbols that are counted.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#$%&*|"
COUNTS = ["n_words", "n_distinct", "n_capitals", "n_points", "n_symbols"]
# Bytes that go through the tables at once, and bytes of texts that share one table of words.
BLOCK, LOT = 1 << 18, 1 << 22

_OUTSIDE, _INSIDE = 0, 1
_STARTS, _CAPITAL, _POINT, _SYMBOL = 1, 2, 4, 8
_M64 = (1 << 64) - 1
_TIMES = 0x9E3779B97F4A7C15
_SPREAD = np.uint64(0xC2B2AE3D27D4EB4F)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(state behind a byte, bits put out for a state and a byte)."""
    behind = np.array([_OUTSIDE if b in BLANKS else _INSIDE for b in range(256)], np.uint8)
    out = np.zeros((2, 256), np.uint8)
    for b in range(256):
        bits = (_CAPITAL if 65 <= b <= 90 else 0) | (_POINT if b & 0xC0 != 0x80 else 0) | (_SYMBOL if b in SYMBOLS else 0)
        out[_INSIDE, b] = bits
        out[_OUTSIDE, b] = bits | (_STARTS if behind[b] == _INSIDE else 0)
    return behind, out.ravel()


_BEHIND, _OUT = _tables()


def _powers(base: int) -> np.ndarray:
    powers = np.empty(BLOCK + 1, np.uint64)
    powers[0], n = 1, 1
    while n < len(powers):
        more = min(n, len(powers) - n)
        powers[n : n + more] = powers[:more] * np.uint64(pow(base, n, 1 << 64))
        n += more
    return powers


_POWER, _INVERSE = _powers(_TIMES), _powers(pow(_TIMES, -1, 1 << 64))


class WordTable:
    """Different words of each document: spans of ``data``, which has eight bytes more than its texts."""

    def __init__(self, data: np.ndarray, size: int = 1 << 12):
        self.data = data
        self.eights = np.ndarray(max(len(data) - 7, 0), "<u8", data, strides=(1,))
        self.count = 0
        self.slots = np.full(size, -1, np.int64)
        self.entries = np.zeros((4, size), np.int64)  # hash, document, start, length

    def _first_slot(self, hashes: np.ndarray, docs: np.ndarray) -> np.ndarray:
        mixed = (hashes.view(np.uint64) ^ docs.view(np.uint64) * _SPREAD) * _SPREAD
        return (mixed >> np.uint64(32)).astype(np.int64) & (len(self.slots) - 1)

    def _make_room(self, n: int) -> None:
        """At most half of the slots are in use when ``n`` more words are in."""
        size = len(self.slots)
        while size < 2 * (self.count + n):
            size *= 2
        if size == len(self.slots):
            return
        entries = np.zeros((4, size), np.int64)
        entries[:, : self.count] = self.entries[:, : self.count]
        self.entries, self.slots = entries, np.full(size, -1, np.int64)
        left = np.arange(self.count)
        at = self._first_slot(*entries[:2, : self.count])
        while len(left):  # all are different, so any free slot will do
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + 1) & (size - 1)

    def _same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether entries are the same word of the same document, by all their bytes."""
        left, right = self.entries[:, a], self.entries[:, b]
        same = (left[[0, 1, 3]] == right[[0, 1, 3]]).all(axis=0)
        todo, done = np.flatnonzero(same), 0
        while len(todo) and done < 64:
            rest = left[3, todo] - done
            apart = self.eights[left[2, todo] + done] ^ self.eights[right[2, todo] + done]
            # bytes behind the word are shifted out
            apart <<= np.maximum(8 - rest, 0).astype(np.uint64) * np.uint64(8)
            same[todo[apart != 0]] = False
            done += 8
            todo = todo[(apart == 0) & (rest > 8)]
        for i in todo:  # long words, one by one
            (x, n), y = left[2:, i], right[2, i]
            same[i] = np.array_equal(self.data[x : x + n], self.data[y : y + n])
        return same

    def insert(self, hashes: np.ndarray, docs: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Add words; True for those that were not there, one of each that comes several times."""
        n = len(hashes)
        self._make_room(n)
        base, mask = self.count, len(self.slots) - 1
        # all stand behind the known ones while they are compared
        self.entries[:, base : base + n] = hashes.view(np.int64), docs, starts, lengths
        new, slot_of = np.zeros(n, bool), np.zeros(n, np.int64)
        left, at = np.arange(base, base + n), self._first_slot(hashes, docs)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            holder = self.slots[at]
            won = holder == left
            new[left[won] - base], slot_of[left[won] - base] = True, at[won]
            left, at, holder = left[~won], at[~won], holder[~won]
            other = ~self._same(left, holder)
            left, at = left[other], (at[other] + 1) & mask
        kept = np.flatnonzero(new)
        self.slots[slot_of[kept]] = base + np.arange(len(kept))
        self.entries[:, base : base + len(kept)] = self.entries[:, base + kept]
        self.count += len(kept)
        return new


def count_texts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """COUNTS, a row each, of texts that lie behind each other in ``data``, UTF-8 bytes; ``ends`` are their ends there."""
    counts = np.zeros((len(COUNTS), len(ends)), np.int64)
    size = int(ends[-1]) if len(ends) else 0
    table = WordTable(np.concatenate([data[:size], np.zeros(8, np.uint8)]))
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    begins = np.zeros(size + 1, bool)
    begins[starts] = True  # no state is carried into another text
    state, is_open, open_start, open_hash = _OUTSIDE, False, 0, 0
    for low in range(0, size, BLOCK):
        high = min(low + BLOCK, size)
        block, first = table.data[low:high], begins[low : high + 1]
        behind = _BEHIND[block]
        before = np.empty_like(behind)
        before[0], before[1:] = state, behind[:-1]
        before[first[:-1]] = _OUTSIDE
        out = _OUT[before.astype(np.uint16) << 8 | block]
        # the texts that have bytes in this block, and where these start
        texts = np.arange(np.searchsorted(ends, low, "right"), np.searchsorted(starts, high, "left"))
        texts = texts[(ends[texts] > low) & (ends[texts] > starts[texts])]
        cuts = np.maximum(starts[texts] - low, 0)
        for row, bit in ((0, _STARTS), (2, _CAPITAL), (3, _POINT), (4, _SYMBOL)):
            counts[row, texts] += np.add.reduceat((out & bit) != 0, cuts, dtype=np.int64)
        # words: a start, and the place behind the last byte
        begin = np.flatnonzero(out & _STARTS)
        last = behind == _INSIDE
        last[:-1] &= (behind[1:] == _OUTSIDE) | first[1:-1]
        last[-1] &= high == size or bool(first[-1]) or table.data[high] in BLANKS
        end = np.flatnonzero(last) + 1
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((block.astype(np.uint64) + np.uint64(1)) * _POWER[: high - low])])
        carried = is_open
        if carried:
            begin = np.concatenate([[0], begin])
        is_open = len(begin) > len(end)
        closed = begin[: len(end)]
        hashes = (sums[end] - sums[closed]) * _INVERSE[closed]
        spans = closed + low
        if carried and len(end):
            hashes[0] = np.uint64((open_hash + int(hashes[0]) * pow(_TIMES, low - open_start, 1 << 64)) & _M64)
            spans[0] = open_start
        if is_open:
            part = int(((sums[-1:] - sums[begin[-1:]]) * _INVERSE[begin[-1:]])[0])
            if carried and len(begin) == 1:
                open_hash = (open_hash + part * pow(_TIMES, low - open_start, 1 << 64)) & _M64
            else:
                open_start, open_hash = low + int(begin[-1]), part
        state = int(behind[-1])
        if len(end):
            docs = np.searchsorted(ends, spans, "right")
            new = table.insert(hashes, docs, spans, end + low - spans)
            counts[1] += np.bincount(docs[new], minlength=len(ends))
    return counts


def measure(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` of the documents, COUNTS of their whole texts, and ``digest``, the SHA-256 of the text.

    Words are maximal runs of other bytes than BLANKS, told apart by case; capitals are A to Z. Null is an empty text.
    A row for each input row; columns of ``keep`` with the name of a count are replaced. A task holds one Arrow batch, and
    tables for texts of LOT bytes, or for one longer text.
    """
    added = StructType.fromDDL(", ".join(f"{c} bigint" for c in COUNTS) + ", digest binary")
    kept = [c for c in keep if c not in added.names]
    source = docs.select(*[docs[f"`{c}`"] for c in kept], docs[f"`{text}`"].cast("string").alias("__text"))
    schema = StructType([*source.drop("__text").schema.fields, *added.fields])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for batch in parts:
            for part in lots(batch, len(kept), LOT):
                texts = part.column(len(kept)).cast(pa.large_binary())
                offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
                data = texts.buffers()[2]
                data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
                places = offsets - offsets[0]
                counts = count_texts(data, places[1:])
                digests = [hashlib.sha256(data[i:j]).digest() for i, j in zip(places[:-1], places[1:], strict=True)]
                arrays = [*part.columns[: len(kept)], *map(pa.array, counts), pa.array(digests, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return source.mapInArrow(run, schema)
