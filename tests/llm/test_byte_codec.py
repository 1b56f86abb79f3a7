import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from panelkit.llm import batches, byte_codec
from tests.llm.test_tokenizers import EDGES, wild

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ours():
    return byte_codec.Codec(PATH, PATTERN)


@pytest.fixture(scope="module")
def library(ours):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ours.rank, special_tokens={})


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def test_ids_as_the_library_has_them(spark, ours, library):
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    marks = [f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}1 's" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    for part in (texts, wild(3000, 11), EDGES, marks, wild(400, 11)):
        got = ours.encode(part)
        assert [ids(g) for g in got] == library.encode_ordinary_batch([t or "" for t in part], num_threads=1)
        assert [ours.decode(g) for g in got] == [(t or "").encode() for t in part]


def test_results_do_not_depend_on_what_is_remembered(ours):
    texts = wild(600, 12)
    want = ours.encode(texts)
    small = byte_codec.Codec(PATH, PATTERN)
    small.known.limit = 2000
    assert [g for k in range(0, len(texts), 7) for g in small.encode(texts[k : k + 7])] == want
    assert small.known.held <= 2000


def test_memory_counts_what_it_holds(ours):
    fresh = byte_codec.Codec(PATH, PATTERN)
    fresh.encode(["one two " + "x" * 200, "two three"])
    held = sum(len(k) + len(v) + batches.ENTRY_BYTES for k, v in fresh.known.items())
    assert fresh.known.held == held and "x" * 200 not in fresh.known and "two" in fresh.known


def test_model_is_the_vocabulary(ours):
    """Piece r + 1 is token r, scored -r; a token that merging does not reach is still itself."""
    rng = random.Random(5)
    by_rank = {r: t for t, r in ours.rank.items()}
    for r in rng.sample(range(len(by_rank)), 2000):
        assert byte_codec.to_bytes(ours.model.id_to_piece(r + 1)) == by_rank[r]
        assert ours.model.get_score(r + 1) == -r
    assert ours.model.is_unknown(0)
    text = " ".join(sorted(ours.whole)[2000:2200])
    assert ours.model.decode(ours.model.encode(byte_codec.to_chars(text.encode()))) == byte_codec.to_chars(text.encode())


def test_decoding_of_any_ids(ours, library):
    rng = random.Random(6)
    for _ in range(500):
        some = [rng.randrange(50_256) for _ in range(rng.randint(0, 9))]
        assert ours.decode(np.array(some, "<u4").tobytes()) == library.decode_bytes(some)


def test_a_small_vocabulary_by_hand(tmp_path):
    import base64

    tokens = [bytes([b]) for b in range(256)] + [b"bc", b"ab", b"abc", b"zzz"]
    file = tmp_path / "small.tiktoken"
    file.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(r).encode() for r, t in enumerate(tokens)))
    small = byte_codec.Codec(str(file), PATTERN)
    assert ids(small.encode(["abcab"])[0]) == [258, 257]
    assert ids(small.encode(["zzz zzz"])[0]) == [259, 32, 122, 122, 122]  # only a whole pre-token is taken unmerged
    model = sentencepiece.SentencePieceProcessor(model_proto=byte_codec.serialise(tokens))
    assert model.vocab_size() == len(tokens) + 1
    file.write_bytes(base64.b64encode(b"a") + b" 0")
    with pytest.raises(ValueError, match="expected kind"):
        byte_codec.Codec(str(file), PATTERN)


def test_rows(spark, documents):
    docs = documents([(1, "é é"), (1, "é é"), (2, None), (None, ""), (3, "word " * 50_000)])
    docs = docs.withColumn("ids_sha256", docs["text"]).withColumn("__text_of_row_", docs["text"])
    rows = byte_codec.codec_digests(docs, PATH, PATTERN).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert [(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows[2:4]] == [
        (2, 0, empty, empty), (None, 0, empty, empty),
    ]
    assert rows[0] == rows[1] and rows[0]["decoded_sha256"] == hashlib.sha256("é é".encode()).hexdigest()
    assert rows[4]["decoded_sha256"] == hashlib.sha256(b"word " * 50_000).hexdigest()
    assert byte_codec.codec_digests(docs.limit(0), PATH, PATTERN).count() == 0
    coded = byte_codec.encode_documents(docs, PATH, PATTERN)
    back = byte_codec.decode_documents(coded, PATH, PATTERN).collect()
    assert [bytes(r["data"]) for r in back[:4]] == ["é é".encode(), "é é".encode(), b"", b""]
    assert coded.columns == ["doc_id", "ids"]


def test_long_texts_come_in_lots(spark, documents, monkeypatch):
    monkeypatch.setattr(byte_codec, "LOT", 1000)
    texts = ["a b c " * 400, "short", None, "d" * 5000, "", "e f"]
    rows = byte_codec.codec_digests(documents(texts).coalesce(1), PATH, PATTERN).collect()
    want = [hashlib.sha256((t or "").encode()).hexdigest() for t in texts]
    assert [r["decoded_sha256"] for r in sorted(rows, key=lambda r: r["doc_id"])] == want
