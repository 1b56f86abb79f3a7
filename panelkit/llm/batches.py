"""Texts handed to numpy code in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# Column that carries the text to the tasks; no input column is called so.
_TEXT = "__text_of_row"
# Bytes of keys and values that a task's memory of words holds, and bytes of a Python object beside them.
MEMORY_BYTES, ENTRY_BYTES = 48 << 20, 170


class Memory(dict):
    """What a task remembers of words that come again, by the bytes that it takes.

    ``trim`` empties it once it holds more than ``limit``; a result never depends on what is remembered.
    """

    def __init__(self, limit: int = MEMORY_BYTES):
        super().__init__()
        self.limit, self.held = limit, 0

    def learn(self, keys: Iterable, values: Iterable) -> None:
        """Add texts or bytes by their keys; ``keys`` are new ones, each once."""
        keys, values = list(keys), list(values)
        self.update(zip(keys, values, strict=True))
        self.held += sum(map(len, keys)) + sum(map(len, values)) + ENTRY_BYTES * len(keys)

    def drop(self, keys: Iterable) -> None:
        """Forget some keys."""
        for k in keys:
            self.held -= len(k) + len(self.pop(k)) + ENTRY_BYTES

    def trim(self, drop: Iterable = ()) -> None:
        """Forget the keys of ``drop``, and everything if too much is held."""
        self.drop(drop)
        if self.held > self.limit:
            self.clear()

    def clear(self) -> None:
        super().clear()
        self.held = 0


def lots(part: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """``part`` in slices of whole rows whose texts have ``limit`` bytes in all, or of one longer row."""
    sizes = part.column(column).nbytes if part.num_rows else 0
    if sizes <= limit:
        yield part
        return
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(part.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if held and held + n > limit:
            yield part.slice(start, i - start)
            start, held = i, 0
        held += n
    yield part.slice(start)


def map_texts(
    df: DataFrame,
    compute: Callable[[list[str | None]], list],
    fields: str,
    text: str = "text",
    keep: list[str] | None = None,
    lot: int | None = None,
) -> DataFrame:
    """Columns ``keep`` of ``df`` (by default all) and, behind them, ``fields`` (a DDL string).

    ``compute`` gets the texts of a batch and gives a list of values per field. Input columns
    with the name of a field are replaced. One task holds one Arrow batch at a time; Spark limits its
    rows and bytes (``spark.sql.execution.arrow.maxRecordsPerBatch``, ``maxBytesPerBatch``). With ``lot``
    ``compute`` gets whole texts of about so many bytes at a time.
    """
    added = StructType.fromDDL(fields)
    kept = [c for c in (df.columns if keep is None else keep) if c not in added.names]
    source = df.select(*[df[f"`{c}`"] for c in kept], df[f"`{text}`"].alias(_TEXT))
    schema = StructType([*source.drop(_TEXT).schema.fields, *added.fields])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        new = [target.field(len(kept) + i) for i in range(len(added))]
        for batch in parts:
            for part in [batch] if lot is None else lots(batch, len(kept), lot):
                made = compute(part.column(len(kept)).to_pylist())
                arrays = [pa.array(v, f.type) for v, f in zip(made, new, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *arrays], schema=target)

    return source.mapInArrow(run, schema)
