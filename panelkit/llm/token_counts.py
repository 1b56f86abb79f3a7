"""Token counts of a byte-level BPE vocabulary, merged on ragged arrays.

Texts are cut into chunks at single spaces between other characters; the pattern that cuts pre-tokens
always cuts there too. Chunks unknown so far are cut into pre-tokens, and all new pre-tokens of
a batch lie behind each other in one array of symbols, with the number of their sequence beside them. One round
finds the lowest-ranked pair of every sequence and merges all its occurrences at once; rounds go on
until no sequence has a pair left. The symbols that survive are the tokens.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from functools import cache
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.batches import map_texts

# Fixed value: the pattern of pre-tokens in the ByteLevel pre-tokenizer of the tokenizers library. White space
# is spelt out, as the regex module counts four control characters to \s that the library does not.
_S = r"\t-\r\x20\x85\xA0  -     　"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
_CUT = re.compile(rf"(?<=[^{_S}]) (?=[^{_S}])")

# Entries that a task's memory of counted chunks and of pre-tokens holds before it is emptied; longer keys are not
# remembered; texts in bytes that are handled at a time.
MEMORY, LONGEST_KEY, LOT = 350_000, 64, 1 << 21


def byte_symbols() -> dict[str, int]:
    """Character that stands for each byte in the vocabulary file: printable ones for themselves, the rest from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """The merge table as sorted arrays: pair of symbols -> rank, and the symbol that the merge makes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocab, merges = file["model"]["vocab"], file["model"]["merges"]
        if file["normalizer"] is not None or file["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"not a byte-level vocabulary: {path}")
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.size = max(vocab.values()) + 1
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        # a round may take all occurrences of a pair only if what it makes never outranks it
        born = np.full(self.size, -1, np.int64)
        born[made] = np.arange(len(pairs))
        if (np.maximum(born[left], born[right]) >= np.arange(len(pairs))).any():
            raise ValueError(f"a merge comes before its parts: {path}")
        order = np.argsort(left * self.size + right)
        self.keys, self.ranks = (left * self.size + right)[order], order
        self.made = made
        self.of_byte = np.zeros(256, np.int64)
        for char, byte in byte_symbols().items():
            self.of_byte[byte] = vocab[char]
        specials = [t["content"] for t in file["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; the number of merges where there is none."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], len(self.keys))

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Number of tokens of each pre-token."""
        n = np.array([len(w) for w in words], np.int64)
        counts = np.minimum(n, 1)
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        of = np.repeat(np.arange(len(words)), n)
        none = len(self.keys)
        while len(symbols) > 1:
            rank = np.full(len(symbols), none, np.int64)  # of a symbol with the one behind it
            inner = np.flatnonzero(of[1:] == of[:-1])
            rank[inner] = self._rank(symbols[inner], symbols[inner + 1])
            start = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            lowest = np.minimum.reduceat(rank, start)
            length = np.diff(np.r_[start, len(of)])
            open_ = lowest < none
            counts[of[start[~open_]]] = length[~open_]  # sequences that are done leave the arrays
            hit = (rank == np.repeat(lowest, length)) & (rank < none)
            # of overlapping pairs, as in aaa, every other one counts, from the left
            run = np.flatnonzero(hit)
            if len(run) == 0:
                return counts
            first = np.r_[True, np.diff(run) != 1]
            since = run - np.maximum.accumulate(np.where(first, run, 0))
            run = run[since % 2 == 0]
            symbols[run] = self.made[rank[run]]
            stay = np.repeat(open_, length)
            stay[run + 1] = False
            symbols, of = symbols[stay], of[stay]
        if len(symbols):
            counts[of] = 1
        return counts


def _chunks(text: str) -> list[str]:
    """``text`` cut at the single spaces between other characters."""
    flat = text.replace("\n", " ")
    return text.split(" ") if " ".join(flat.split()) == flat else _CUT.split(text)


def _forget(memory: dict[str, int], keys: Iterable[str]) -> None:
    for k in keys:
        if len(k) > LONGEST_KEY:
            del memory[k]


class Counter:
    """Token counts of texts, remembering chunks and pre-tokens that come again."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.pattern = regex.compile(PATTERN)
        self.chunks: dict[str, int] = {}
        self.words: dict[str, int] = {}

    def _pieces(self, text: str) -> tuple[int, list[list[str]]]:
        """Number of special tokens, and the chunks of the texts between them; all chunks but a text's first lack
        the space before them."""
        parts = self.merges.special.split(text) if self.merges.special else [text]
        return len(parts) - 1, [_chunks(p) for p in parts if p]

    def _learn(self, chunks: set[str]) -> dict[str, int]:
        """Token counts of chunks."""
        chunks = list(chunks)
        cut = list(map(self.pattern.findall, chunks))
        if len(self.words) > MEMORY:
            self.words.clear()
        new = list(set(chain.from_iterable(cut)).difference(self.words))
        counted = self.merges.counts([w.encode("utf-8", "surrogatepass") for w in new])
        self.words.update(zip(new, counted.tolist(), strict=True))
        get = self.words.__getitem__
        counts = [sum(map(get, words)) for words in cut]
        _forget(self.words, new)
        return dict(zip(chunks, counts, strict=True))

    def count(self, texts: list[str | None]) -> list[int]:
        """Number of tokens of each text."""
        cut = [self._pieces(t or "") for t in texts]
        if len(self.chunks) > MEMORY:
            self.chunks.clear()
        first = {c[0] for _, parts in cut for c in parts}
        new: set[str] = set()
        for _, parts in cut:
            for c in parts:
                new.update(c)
        new.difference_update(self.chunks)
        found = self._learn({" " + c for c in new} | first)
        self.chunks.update((c, found[" " + c]) for c in new)
        get = self.chunks.__getitem__
        counts = [n + sum(found[c[0]] - get(c[0]) + sum(map(get, c)) for c in parts) for n, parts in cut]
        _forget(self.chunks, new)
        return counts


@cache
def _counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 1024, text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text, by the vocabulary file at ``path``.

    Special strings inside a text count as one token each, as the tokenizers library has it by default. Null and
    empty texts have no tokens. A row for each input row, also where ids repeat or are null.
    """

    def count(texts: list[str | None]) -> list:
        sizes = [len((t or "").encode("utf-8", "surrogatepass")) for t in texts]
        return [sizes, _counter(path).count(texts)]

    counted = map_texts(docs, count, "n_bytes bigint, n_tokens bigint", text, ["doc_id"], LOT)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
