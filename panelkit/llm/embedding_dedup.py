"""Near-duplicate vectors by sign hashing, exact cosines and connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from panelkit.llm.blocks import block_pairs, compare, forest
from panelkit.llm.components import components
from panelkit.sources.staging import stage

# Least and most bits of a table; the chance of a pair at the threshold to be in no bucket together; vectors that are
# hashed at a time.
BITS, MISSED, LOT, SEED = (12, 24), 0.009, 1_000, 7
SIMILARITY = 0.93


def sizes(n: int, similarity: float = SIMILARITY) -> tuple[int, int]:
    """(tables, bits) for ``n`` vectors: buckets as many as vectors, so that what meets by chance grows with the vectors, not
    with their square; and tables enough for a pair at the threshold to share a bucket of one but for MISSED.

    Two vectors at an angle share a bit with probability 1 - angle / pi. At cosine 0.93 that is 0.880, so 12 bits take 20
    tables, 16 take 35, 20 take 59; the tables grow with the 0.18th power of the vectors.
    """
    bits = min(max(math.ceil(math.log2(max(n, 1))), BITS[0]), BITS[1])
    same = (1 - math.acos(similarity) / math.pi) ** bits
    return (math.ceil(math.log(MISSED) / math.log(1 - same)) if same < 1 else 1), bits


def _planes(dim: int, tables: int, bits: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, tables * bits))


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def sign_codes(vectors: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """One number per vector and table: the sides of ``bits`` random hyperplanes that the vector lies on."""
    planes, weights = _planes(vectors.shape[1], tables, bits), 1 << np.arange(bits, dtype=np.int32)
    codes = np.empty((len(vectors), tables), np.int32)
    for k in range(0, len(vectors), LOT):
        signs = _unit(vectors[k : k + LOT]) @ planes > 0
        codes[k : k + LOT] = signs.reshape(-1, tables, bits) @ weights
    return codes


def _usable(vector) -> F.Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _coded(reps: DataFrame, tables: int, bits: int) -> DataFrame:
    """Codes of each distinct vector; rows come in batches, vectors of different lengths are hashed apart."""

    def code(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lists = part.column(3)
            sizes = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(sizes)
            codes = np.zeros((len(sizes), tables), np.int32)
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                codes[rows] = sign_codes(values[(ends[rows] - dim)[:, None] + np.arange(dim)], tables, bits)
            made = pa.ListArray.from_arrays(np.arange(len(sizes) + 1, dtype=np.int32) * tables, pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*part.columns, made], names=["first", "copies", "label", "vector", "codes"])

    plain = reps.select("first", "copies", "label", "vector")
    return plain.mapInArrow(code, StructType([*plain.schema.fields, StructField("codes", ArrayType(IntegerType()))]))


def near_duplicates(
    rows: DataFrame,
    similarity: float = SIMILARITY,
    tables: int | None = None,
    bits: int | None = None,
    vector: str = "embedding",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of (vec_id, label, ``vector``).

    Rows link where their labels are equal and the cosine is ``similarity`` or more. Equal vectors of a label are
    compared once and always link. All others that share a bucket of one of the ``tables`` are compared,
    exactly; nothing is capped. Tables and their ``bits`` follow the number of distinct vectors (``sizes``) if not given. ``n_links`` counts other rows, ``component_id`` is the smallest vec_id that links
    reach, ``kept`` marks the rows with that id. Link with nothing: null labels and ids, null or empty vectors, those
    of zeros only or with a null, NaN or infinite number, and vectors of different lengths. A null id has a null
    component and is kept. Rows that repeat an id count as rows. An empty table gives no rows.
    """
    kept_type = dict(rows.dtypes)[vector] in ("array<float>", "array<double>")
    numbers = F.col(f"`{vector}`") if kept_type else F.col(f"`{vector}`").cast("array<double>")
    source = rows.select("vec_id", "label", numbers.alias("vector"))
    usable = _usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    same = source.filter(usable).groupBy("label", "vector")
    reps = same.agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    if tables is None or bits is None:
        reps = stage(reps, "vectors")
        tables, bits = sizes(reps.count(), similarity)
    # numbered as they are written, so that every later reading sees one number for a distinct vector
    coded = stage(_coded(reps, tables, bits).withColumn("id", F.monotonically_increasing_id()), "codes")
    found = stage(_links(coded, similarity), "links")

    linked = found.groupBy("id").agg(F.sum("n").alias("linked"))
    rooted = coded.drop("codes").join(linked, "id", "left").join(components(found, "id", "low"), "id", "left")
    rooted = stage(rooted.withColumn("root", F.coalesce("component_id", "id")).drop("component_id"), "roots")
    least = stage(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    n_links = (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")
    per_rep = stage(rooted.join(least, "root").select("label", "vector", n_links, "component_id"), "classes")
    judged = source.withColumn("label", F.when(usable, F.col("label"))).join(per_rep, ["label", "vector"], "left")
    return judged.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _links(coded: DataFrame, similarity: float) -> DataFrame:
    """(id, low, n): for pairs of blocks, the vectors with links, how many rows they link with, and the smallest id
    of their block pair that they reach. A pair of vectors counts in the first table that puts both in a bucket.

    Buckets and blocks are made of numbers; the vectors join what is left of them.
    """
    in_buckets = coded.select("id", "label", F.size("vector").alias("size"), F.posexplode("codes").alias("t", "code"))
    narrow = in_buckets.select("id", "t", F.xxhash64("label", "size", "t", "code").alias("bucket"))
    pairs = block_pairs(stage(narrow, "buckets"), "id")
    wide = pairs.join(coded.select("id", "copies", F.xxhash64("label").alias("label"), "vector", "codes"), "id")

    def load(group: pd.DataFrame) -> dict[str, np.ndarray]:
        size = group["vector"].map(len).to_numpy()
        vectors = np.zeros((len(group), size.max()), np.float64)
        for i, v in enumerate(group["vector"]):
            vectors[i, : len(v)] = v
        codes = np.stack(group["codes"].to_numpy())
        plain = {c: group[c].to_numpy() for c in ("id", "copies", "label", "t")}
        return plain | {"size": size, "unit": _unit(vectors), "codes": codes}

    def each(data: dict[str, np.ndarray], rows: np.ndarray, others: np.ndarray | None) -> tuple[np.ndarray, ...]:
        itself = others is None
        others = rows if itself else others
        linked = data["unit"][rows] @ data["unit"][others].T >= similarity
        for c in ("label", "size", "t"):  # differ only where two buckets have one hash
            linked &= data[c][rows][:, None] == data[c][others][None, :]
        if itself:
            linked = np.triu(linked, 1)
        i, j = np.nonzero(linked)
        t = data["t"][rows[0]] if len(rows) else 0
        met = (data["codes"][rows[i], :t] == data["codes"][others[j], :t]).any(axis=1)
        linked[i[met], j[met]] = False
        n, m = linked @ data["copies"][others], data["copies"][rows] @ linked
        low, low_other = forest(linked, data["id"][rows], data["id"][others])
        ids = np.r_[data["id"][rows], data["id"][others]]
        n, low = np.r_[n, m], np.r_[low, low_other]
        return ids[n > 0], low[n > 0], n[n > 0]

    return compare(wide, load, each, "id bigint, low bigint, n bigint")
