"""Encoding and decoding with a merge-type sentencepiece vocabulary, by backtracking.

A text cut into pieces is what merging would give exactly if merging every two neighbours for themselves
gives those two again: the first merge across a boundary would also happen in that pair alone. So the
encoder walks through a text with the longest piece that an Aho-Corasick automaton finds at each place, checks it
against the piece before by re-merging the two, takes shorter pieces where that fails, and steps back where none is
left. A place that was given up once is marked in a bitfield and never tried again: the pieces up to a place
are unique.

No piece holds a word mark behind another character (checked on loading), so texts are encoded in chunks of
marks and the characters behind them, and chunks that come again are remembered.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from functools import cache

import ahocorasick
import sentencepiece
from pyspark.sql import DataFrame

from panelkit.llm.batches import Memory, map_texts

# Fixed value: the character that stands for a space in pieces.
MARK = "▁"
_CHUNK = re.compile(rf"{MARK}+[^{MARK}]*|^[^{MARK}]+")
_SPACED = re.compile(r" +[^ ]*")
# Checked pairs that a task remembers before it forgets them; longer chunks are not remembered; texts in bytes that are
# handled at a time.
PAIRS, LONGEST_KEY, LOT = 150_000, 64, 1 << 20
REPLACEMENT = "�"


class Codec:
    """A vocabulary file of the merge type with byte fallback, identity normalisation and a mark before each text."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.end = model.eos_id()
        self.surface = [model.id_to_piece(i) for i in range(n)]
        self.byte_of = {i: int(self.surface[i][3:5], 16) for i in range(n) if model.is_byte(i)}
        self.id_of_byte = {b: i for i, b in self.byte_of.items()}
        special = {i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.special = special
        self.ids = {p: i for i, p in enumerate(self.surface) if i not in special and i not in self.byte_of}
        self.whole = frozenset(self.ids.values())  # neither bytes nor special
        self.score = {p: model.get_score(i) for p, i in self.ids.items()}
        if len(self.byte_of) != 256 or any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError(f"not a vocabulary of the expected kind: {path}")
        for probe in (" a  b\n", "ﬁ①"):
            if model.decode(model.encode(probe)) != probe:
                raise ValueError(f"the vocabulary normalises texts: {path}")
        self.length = [len(p) for p in self.surface]
        self.decimal = [str(i) for i in range(n)]
        reached = {p: i for p, i in self.ids.items() if self.merge(p) == [i]}  # others are never given
        self.automaton = ahocorasick.Automaton()
        # of each piece the longest shorter one that it starts with, -1 if there is none
        self.shorter = [-1] * n
        for p, i in reached.items():
            self.automaton.add_word(p, i)
            self.shorter[i] = next((reached[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in reached), -1)
        self.automaton.make_automaton()
        self.characters = frozenset(p for p in self.ids if len(p) == 1)
        self.pairs: dict[int, bool] = {}
        # ids of a chunk as decimal text, and its decoded text where that is another one
        self.chunks, self.changed = Memory(), Memory()

    def merge(self, text: str) -> list[int | str]:
        """Pieces of a short text by merging the best-scored pair, the leftmost of equals, until none is left.

        Characters without a piece stay as they are."""
        parts = list(text)
        score, none = self.score.get, -math.inf
        scores = [score(a + b, none) for a, b in itertools.pairwise(parts)]
        while scores and (best := max(scores)) > none:
            i = scores.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = score(parts[i - 1] + parts[i], none)
            if i < len(scores):
                scores[i] = score(parts[i] + parts[i + 1], none)
        return [self.ids.get(p, p) for p in parts]

    def fits(self, left: int, right: int) -> bool:
        """True if merging the two pieces alone gives them again."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            known = self.merge(self.surface[left] + self.surface[right]) == [left, right]
            self.pairs[key] = known
        return known

    def _run(self, text: str) -> list[int]:
        """Pieces of a text all of whose characters have one."""
        n = len(text)
        length, shorter, known = self.length, self.shorter, self.pairs.get
        longest = [-1] * (n + 1)  # by start; found by their ends, so the longest comes last
        for last, piece in self.automaton.iter(text):
            longest[last + 1 - length[piece]] = piece
        given_up = bytearray(n // 8 + 1)
        pieces: list[int] = []
        at, before, piece = 0, -1, longest[0]
        while at < n:
            while piece >= 0:
                to = at + length[piece]
                if not given_up[to >> 3] >> (to & 7) & 1:
                    fit = before < 0 or known(before << 32 | piece)
                    if self.fits(before, piece) if fit is None else fit:
                        break
                piece = shorter[piece]
            else:
                given_up[at >> 3] |= 1 << (at & 7)
                last = pieces.pop()
                at -= length[last]
                before, piece = pieces[-1] if pieces else -1, shorter[last]
                continue
            pieces.append(piece)
            at, before, piece = to, piece, longest[to]
        return pieces

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of a chunk. A character without a piece never merges, so it parts the chunk, and gives its bytes."""
        if self.characters.issuperset(chunk):
            return self._run(chunk)
        out: list[int] = []
        start = 0
        for i, char in enumerate(chunk):
            if char not in self.ids:
                out += self._run(chunk[start:i])
                out += [self.id_of_byte[b] for b in char.encode("utf-8", "surrogatepass")]
                start = i + 1
        return out + self._run(chunk[start:])

    def decode(self, ids: list[int]) -> str:
        """Text of a sequence of ids; control ids give nothing, the first mark goes, bytes that are no UTF-8 give a
        replacement character each."""
        if self.whole.issuperset(ids):
            return "".join([self.surface[i] for i in ids]).removeprefix(MARK).replace(MARK, " ")
        out: list[str] = []
        data = bytearray()
        for i in [*ids, -1]:
            if i in self.byte_of:
                data.append(self.byte_of[i])
                continue
            if data:
                out.append(_text_of(bytes(data)))
                data.clear()
            if i >= 0 and i not in self.special:
                out.append(self.surface[i])
        text = "".join(out)
        return text.removeprefix(MARK).replace(MARK, " ")

    def _learn(self, chunks: list[str]) -> None:
        """Remember chunks, with spaces for their marks: their ids as decimal text, and how they are decoded with all their
        spaces, if not as they are: of what is decoded, the mark put in front is the one that goes."""
        digits, other = [], {}
        for c in chunks:
            ids = self.encode_chunk(c.replace(" ", MARK))
            digits.append(" ".join([self.decimal[i] for i in ids]).encode())
            decoded = self.decode([self.ids[MARK], *ids])
            if decoded != c:
                other[c] = decoded
        self.chunks.learn(chunks, digits)
        self.changed.learn(other, other.values())

    def digest(self, texts: list[str | None]) -> list:
        """Number of ids (with the end id), hash of the ids, hash of the decoded text, of each text."""
        sizes, id_hashes, text_hashes = [], [], []
        end = str(self.end).encode()
        # marks of a text are spaces to the codec; chunks keep spaces, as texts of one byte a character are handled faster
        spaced = [" " + t.replace(MARK, " ") if t else "" for t in texts]
        cut = [_SPACED.findall(t) for t in spaced]
        new = list(set().union(*cut).difference(self.chunks))
        self._learn(new)
        get, changed = self.chunks.__getitem__, self.changed
        for text, chunks in zip(spaced, cut, strict=True):
            ids = b" ".join([*map(get, chunks), end])
            sizes.append(ids.count(b" ") + 1)
            id_hashes.append(hashlib.sha256(ids).hexdigest())
            # the mark that encoding puts before a text is the one that decoding takes away
            some = changed and not changed.keys().isdisjoint(chunks)
            decoded = "".join([changed.get(c) or c for c in chunks]) if some else text
            text_hashes.append(hashlib.sha256(decoded[1:].encode("utf-8")).hexdigest())
        long = [c for c in new if len(c) > LONGEST_KEY]
        self.chunks.drop(long)
        self.changed.drop(c for c in long if c in self.changed)
        if self.chunks.held + self.changed.held > self.chunks.limit:
            self.chunks.clear()
            self.changed.clear()
        return [sizes, id_hashes, text_hashes]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text with the end id."""
        chunks = _CHUNK.findall(MARK + text.replace(" ", MARK)) if text else []
        return [i for c in chunks for i in self.encode_chunk(c)] + [self.end]


def _text_of(data: bytes) -> str:
    """``data`` as text, with a replacement character for each byte that belongs to none."""
    out, i = [], 0
    while i < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[i : i + n].decode("utf-8"))
                i += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append(REPLACEMENT)
            i += 1
    return "".join(out)


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def encode_documents(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(doc_id, ids): the whole text of each row as ids with the end id; null and empty texts give the end id alone.

    A row for each input row, also where ids repeat or are null.
    """

    def run(texts: list[str | None]) -> list:
        return [[codec(path).encode(t) for t in texts]]

    return map_texts(docs, run, "ids array<int>", text, ["doc_id"], LOT)


def codec_digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, encoded and decoded again.

    Null and empty texts give the end id alone and decode to an empty text. A row for each input row.
    """

    def run(texts: list[str | None]) -> list:
        return codec(path).digest(texts)

    return map_texts(docs, run, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", text, ["doc_id"], LOT)
