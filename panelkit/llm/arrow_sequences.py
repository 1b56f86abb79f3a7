"""Token ids as Arrow files of equal-length sequences.

Documents are dealt out by ranges of ids; each range is encoded in order and written to one file in the Arrow
file format: record batches of ``tokens`` (fixed-size list of ids) and ``mask`` (fixed-size list, false
behind the last id). A reader maps a file and gets to any sequence by its number without copying. An index, one row for
each document, tells the file and the place of its ids.

A file gets a new name with each attempt of its task, and only the names that the finished tasks returned are in the
index, so files of lost executors are never read.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.llm.batches import Memory
from panelkit.sources.staging import new_folder, stage

SEQUENCE, BATCH = 1024, 256
# Bytes that a task's memory of encoded words holds before it is emptied; longer words are not remembered; texts that
# are cut into words at a time.
MEMORY, LONGEST_KEY, TEXTS = 208 << 20, 64, 1000
# Words of letters that stand for themselves: their small forms are single characters too, and nothing in them composes.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")
_INDEX = "doc_id bigint, file string, place bigint, n_tokens bigint"


class WordEncoder:
    """Ids of texts by a tokenizers file whose pre-tokenizer never keeps a space or line end inside a token.

    A text is cut there, and the words that come again are remembered. Words of plain letters, in capitals or with a
    full stop or comma behind them, are encoded once in small letters, by a second tokenizer of the same vocabulary that
    leaves out the rules which do nothing to them. All other words go through the file's own rules as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks of an executor share its cores already
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        rules = json.loads(self.model.to_str())
        steps = [n["type"] for n in rules["normalizer"]["normalizers"]]
        cuts = rules["pre_tokenizer"]["pretokenizers"]
        if (
            steps != ["NFC", "Replace", "Lowercase"]
            or [c["type"] for c in cuts] != ["Split", "ByteLevel"]
            or r"[\p{L}]+" not in cuts[0]["pattern"]["Regex"]
            or any("<" not in t["content"] for t in rules["added_tokens"])
        ):
            raise ValueError(f"not a vocabulary of the expected kind: {path}")
        bytes_only = rules | {"normalizer": None, "pre_tokenizer": cuts[1], "added_tokens": [], "post_processor": None}
        self.plain = Tokenizer.from_str(json.dumps(bytes_only))
        self.dtype = np.dtype("<u2" if self.model.get_vocab_size() <= 1 << 16 else "<u4")
        self.words = Memory(MEMORY)
        self.stops = dict(zip(("", ".", ","), self._ids(self.model, ["", ".", ","]), strict=True))

    def _ids(self, model, words: list[str]) -> list[bytes]:
        """Ids of words, all of a lot in one array."""
        out: list[bytes] = []
        width = self.dtype.itemsize
        for k in range(0, len(words), 10_000):
            coded = [c.ids for c in model.encode_batch_fast(words[k : k + 10_000], add_special_tokens=False)]
            ends = np.cumsum([len(ids) for ids in coded]) * width
            data = np.fromiter(chain.from_iterable(coded), self.dtype).tobytes()
            out += [data[i:j] for i, j in pairwise([0, *ends.tolist()])]
        return out

    def _learn(self, words: list[bytes]) -> list[bytes]:
        """Ids of words."""
        texts = [w.decode("utf-8", "surrogatepass") for w in words]
        found = list(map(_PLAIN.fullmatch, texts))
        parts = [(m[1].lower(), m[2]) if m else None for m in found]
        of = {p[0]: self.words.get(p[0].encode()) for p in parts if p}
        stems = [s for s, ids in of.items() if ids is None]
        whole = [t for t, m in zip(texts, found, strict=True) if not m]
        of.update(zip(stems, self._ids(self.plain, stems), strict=True))
        others = iter(self._ids(self.model, whole))
        return [of[p[0]] + self.stops[p[1]] if p else next(others) for p in parts]

    def encode(self, texts: list[str | bytes | None]) -> Iterator[bytes]:
        """Ids of each text, or of its UTF-8 bytes, as the bytes of an array of ``dtype``; null and empty texts have none."""
        for k in range(0, len(texts), TEXTS):
            part = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else t or b"" for t in texts[k : k + TEXTS]]
            cut = [t.split() for t in part]
            new = list(set().union(*cut).difference(self.words))
            self.words.learn(new, self._learn(new))
            get = self.words.__getitem__
            yield from [b"".join(map(get, words)) for words in cut]
            self.words.trim(w for w in new if len(w) > LONGEST_KEY)


@cache
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


class SequenceWriter:
    """Packs a stream of ids into sequences and writes them in record batches."""

    def __init__(self, sink, dtype: np.dtype, length: int = SEQUENCE, batch: int = BATCH):
        ids = pa.list_(pa.field("item", pa.from_numpy_dtype(dtype), nullable=False), length)
        mask = pa.list_(pa.field("item", pa.bool_(), nullable=False), length)
        self.schema = pa.schema([pa.field("tokens", ids), pa.field("mask", mask)])
        self.length, self.room = length, length * batch
        self.dtype, self.held, self.bytes_held = dtype, [], 0
        self.writer = pa.ipc.new_file(sink, self.schema)

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.bytes_held += len(ids)
        if self.bytes_held >= self.room * self.dtype.itemsize:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.held), self.dtype)
        for start in range(0, len(ids), self.room):
            part = ids[start : start + self.room]
            if len(part) < self.room and not last:
                break
            n = len(part)
            full = -(-n // self.length) * self.length
            padded = np.zeros(full, self.dtype)
            padded[:n] = part
            columns = [
                pa.FixedSizeListArray.from_arrays(pa.array(v), type=self.schema.field(i).type)
                for i, v in enumerate((padded, np.arange(full) < n))
            ]
            self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        else:
            start = len(ids)
        self.held = [ids[start:].tobytes()]
        self.bytes_held = len(self.held[0])

    def close(self) -> None:
        self._flush(last=True)
        self.writer.close()


class SequenceFile:
    """A written file, mapped where its file system allows it; ids and sequences by their number."""

    def __init__(self, uri: str):
        fs, path = pyarrow.fs.FileSystem.from_uri(uri)
        local = isinstance(fs, pyarrow.fs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else fs.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("tokens").type.list_size
        self.room = self.length * (self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 1)
        self._at, self._ids = -1, np.empty(0)

    def _batch(self, k: int) -> np.ndarray:
        if k != self._at:
            self._ids = self.reader.get_batch(k).column("tokens").flatten().to_numpy(zero_copy_only=True)
            self._at = k
        return self._ids

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of one sequence; the ids are a view of the file."""
        k, row = divmod(number, self.room // self.length)
        mask = self.reader.get_batch(k).column("mask")[row].values.to_numpy(zero_copy_only=False)
        return self._batch(k)[row * self.length : (row + 1) * self.length], mask

    def ids(self, place: int, n: int) -> Iterator[np.ndarray]:
        """The ids from a place on, as views of the record batches that hold them."""
        while n > 0:
            k, inner = divmod(place, self.room)
            part = self._batch(k)[inner : inner + n]
            yield part
            place, n = place + len(part), n - len(part)

    def close(self) -> None:
        self.source.close()


def _uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}"


def write_sequences(
    docs: DataFrame, folder: str, path: str, end_id: int, length: int = SEQUENCE, text: str = "text"
) -> DataFrame:
    """Encode the documents with the tokenizers file at ``path``, ``end_id`` behind each, write them to
    ``folder`` in ascending doc_id order; gives the index (doc_id, file, place, n_tokens), itself written.

    ``folder`` is shared by all executors. Null and empty texts have the end id alone; a null doc_id comes first;
    rows that repeat an id follow each other in the order of a hash of their texts. Without documents there are no
    files. The last sequence of a file is padded.
    """
    spark = docs.sparkSession
    uri = _uri(folder)
    fields = [F.col("doc_id"), F.col(f"`{text}`").alias("text")]
    order = ["doc_id", F.xxhash64("text")]
    ordered = docs.select(*fields).repartitionByRange(*order).sortWithinPartitions(*order)

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        end = np.array([end_id], encoder.dtype).tobytes()
        width = encoder.dtype.itemsize
        writer, name, place = None, "", 0
        fs, root = pyarrow.fs.FileSystem.from_uri(uri)
        for part in parts:
            if part.num_rows == 0:
                continue
            if writer is None:
                fs.create_dir(root, recursive=True)
                name = f"part-{uuid.uuid4().hex}.arrow"
                writer = SequenceWriter(sink := fs.open_output_stream(f"{root}/{name}"), encoder.dtype, length)
            sizes = []
            for ids in encoder.encode(part.column(1).cast(pa.binary()).to_pylist()):
                writer.add(ids + end)
                sizes.append(len(ids) // width + 1)
            places = place + np.r_[0, np.cumsum(sizes)[:-1]]
            place += sum(sizes)
            rows = [part.column(0), pa.array([f"{uri}/{name}"] * len(sizes)), pa.array(places, pa.int64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(rows, names=["doc_id", "file", "place", "n_tokens"])
        if writer is not None:
            writer.close()
            sink.close()

    return stage(ordered.mapInArrow(write, _INDEX), "index")


def file_starts(index: DataFrame) -> DataFrame:
    """(file, start): number of ids in all files before it. One row for each file, so one small window does."""
    files = index.groupBy("file").agg(
        F.sum("n_tokens").alias("n"), F.min(F.struct("doc_id", "file")).alias("first")
    )
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))


def read_digests(index: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files.

    ``start`` counts the ids of all documents before it; the checksum is over its ids as little-endian unsigned 32-bit
    integers. An executor reads each file in the order of its documents.
    """

    def read(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place", kind="stable")
        file = SequenceFile(rows["file"].iloc[0])
        sums = []
        for place, n in zip(rows["place"], rows["n_tokens"], strict=True):
            crc = 0
            for part in file.ids(place, n):
                crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
            sums.append(crc)
        file.close()
        rows["ids_crc32"] = sums
        rows["start"] += rows["place"]
        return rows[["doc_id", "start", "n_tokens", "ids_crc32"]]

    starts = F.broadcast(file_starts(index))  # a row for each file, that is for each task of the writing stage
    fields = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return index.join(starts, "file").groupBy("file").applyInPandas(read, fields)


def round_trip(spark: SparkSession, docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Write the documents to a new shared folder and read their digests back."""
    return read_digests(write_sequences(docs, new_folder(spark, "sequences"), path, end_id))
