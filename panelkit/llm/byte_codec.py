"""Byte-level BPE through a sentencepiece model that is written from the vocabulary.

A file of ranks (token bytes and rank) becomes a sentencepiece model of the BPE type: each byte is mapped to a
character of its own, each token is a piece of such characters with the negative rank as its score, and the
normaliser leaves texts as they are. Merging the best-scored pair is then merging the lowest-ranked one. A pre-token
that is a token itself is that token, whatever merging would give; all others go through the model. Decoding joins the
pieces and maps their characters back to bytes.

A single space between two other characters always starts a pre-token, so texts are cut there first, and what lies
between is remembered with its ids.
"""

from __future__ import annotations

import base64
import codecs
import contextlib
import hashlib
import struct
from functools import cache
from itertools import chain, pairwise

import numpy as np
import regex
import sentencepiece
from pyspark.sql import DataFrame

from panelkit.llm.batches import Memory, map_texts

# Field numbers and types in the public sentencepiece model format (protocol buffers).
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_NORMAL, _UNKNOWN, _BPE = 1, 2, 2
_MODEL_TYPE, _UNK_ID, _BOS_ID, _EOS_ID, _PAD_ID = 3, 40, 41, 42, 43
_NAME, _DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE_SPACES = 1, 3, 4, 5
# The character of byte b is the one b places behind this one; none of them is special in any way.
FIRST_CHAR = 0x100
ALPHABET = "".join(chr(FIRST_CHAR + b) for b in range(256))
_TO_BYTES = codecs.charmap_build(ALPHABET)
# Texts in bytes that are handled at a time; longer keys are not remembered.
LOT, LONGEST_KEY = 1 << 20, 64


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def to_chars(data: bytes) -> str:
    """A character for each byte."""
    return codecs.charmap_decode(data, "strict", ALPHABET)[0]


def to_bytes(chars: str) -> bytes:
    """The bytes that the characters stand for."""
    return codecs.charmap_encode(chars, "strict", _TO_BYTES)[0]


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece model of tokens in the order of their ranks: piece 0 is unknown, piece r + 1 has rank r."""
    pieces = [_block(1, b"<unk>") + _number(3, _UNKNOWN)]
    for rank, token in enumerate(tokens):
        score = _varint(2 << 3 | 5) + struct.pack("<f", -rank)
        pieces.append(_block(1, to_chars(token).encode()) + score + _number(3, _NORMAL))
    trainer = _number(_MODEL_TYPE, _BPE) + _number(_UNK_ID, 0)
    trainer += b"".join(_number(f, -1) for f in (_BOS_ID, _EOS_ID, _PAD_ID))
    normalizer = _block(_NAME, b"identity")
    normalizer += b"".join(_number(f, 0) for f in (_DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE_SPACES))
    return b"".join(_block(_PIECES, p) for p in pieces) + _block(_TRAINER, trainer) + _block(_NORMALIZER, normalizer)


class Codec:
    """A vocabulary of ranks and the pattern of its pre-tokens.

    The ranks have to be 0, 1, 2, ... and every byte a token. ``pattern`` is read as the rank libraries read it:
    white space is the Unicode property, which the regex module's own class is not.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        tokens = sorted(self.rank, key=self.rank.__getitem__)
        if [self.rank[t] for t in tokens] != list(range(len(tokens))) or any(bytes([b]) not in self.rank for b in range(256)):
            raise ValueError(f"not a vocabulary of the expected kind: {path}")
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(tokens))
        if self.model.vocab_size() != len(tokens) + 1:
            raise ValueError(f"tokens were lost on the way into the model: {path}")
        self.pattern = regex.compile(pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))
        self.cut = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")
        self.whole = {}
        for token, r in self.rank.items():
            with contextlib.suppress(UnicodeDecodeError):  # no text is such a token
                self.whole[token.decode()] = struct.pack("<I", r)
        # the inverse mapping, read from the model itself
        self.token = [to_bytes(self.model.id_to_piece(r + 1)) for r in range(len(tokens))]
        self.known = Memory()

    def pretokens(self, words: list[str]) -> dict[str, bytes]:
        """Ids of pre-tokens, as little-endian unsigned 32-bit integers."""
        found = {w: ids for w in words if (ids := self.whole.get(w)) is not None}
        rest = [w for w in words if w not in found]
        coded = self.model.encode([to_chars(w.encode()) for w in rest], out_type=int, num_threads=1)
        ends = np.cumsum([len(ids) for ids in coded], dtype=np.int64)
        flat = np.fromiter(chain.from_iterable(coded), np.int64, ends[-1] if len(ends) else 0)
        data = (flat - 1).astype("<u4").tobytes()
        places = pairwise([0, *(4 * ends).tolist()])
        found.update((w, data[i:j]) for w, (i, j) in zip(rest, places, strict=True))
        return found

    def _learn(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks."""
        cut = list(map(self.pattern.findall, chunks))
        get = self.pretokens(list(set(chain.from_iterable(cut)))).__getitem__
        return [get(words[0]) if len(words) == 1 else b"".join(map(get, words)) for words in cut]

    def _chunks(self, text: str) -> list[str]:
        """``text`` cut at single spaces between other characters; all chunks but the first lack the space before them."""
        flat = text.replace("\n", " ")
        # most texts have single blanks only, and splitting at them is many times faster than the pattern
        return text.split(" ") if " ".join(flat.split()) == flat else self.cut.split(text)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers; null and empty texts have none."""
        cut = [self._chunks(t or "") for t in texts]
        starts = [c.pop(0) for c in cut]
        new = list(set().union(*cut).difference(self.known))
        learned = self._learn([*[f" {c}" for c in new], *starts])
        self.known.learn(new, learned[: len(new)])
        get = self.known.__getitem__
        coded = [b"".join([start, *map(get, chunks)]) for start, chunks in zip(learned[len(new) :], cut, strict=True)]
        self.known.trim(c for c in new if len(c) > LONGEST_KEY)
        return coded

    def decode(self, ids: bytes) -> bytes:
        """The bytes that a sequence of ids stands for."""
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@cache
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """(doc_id, ids): the whole text of each row as ids; null and empty texts have none.

    A row for each input row, also where ids repeat or are null.
    """

    def run(texts: list[str | None]) -> list:
        return [[np.frombuffer(ids, "<u4").tolist() for ids in codec(path, pattern).encode(texts)]]

    return map_texts(docs, run, "ids array<int>", text, ["doc_id"], LOT)


def decode_documents(coded: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """The rows with ``data``: the bytes that their ids stand for; null ids have none."""

    def run(rows: list[list[int] | None]) -> list:
        return [[codec(path, pattern).decode(np.array(r or [], "<u4").tobytes()) for r in rows]]

    return map_texts(coded, run, "data binary", ids)


def codec_digests(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, encoded and decoded again.

    The ids are hashed as little-endian unsigned 32-bit integers, the decoded bytes as they are. Null and empty texts have
    no ids. A row for each input row, also where ids repeat or are null; columns of ``docs`` beside id and text are not
    read.
    """

    def run(texts: list[str | None]) -> list:
        ours = codec(path, pattern)
        rows = [
            (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(ours.decode(ids)).hexdigest())
            for ids in ours.encode(texts)
        ]
        return [list(v) for v in zip(*rows, strict=True)] if rows else [[], [], []]

    return map_texts(docs, run, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", text, ["doc_id"], LOT)
