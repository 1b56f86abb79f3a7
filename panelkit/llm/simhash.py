"""Near-duplicate texts by SimHash fingerprints, with pigeonring filtering.

The 64 bits of a fingerprint are a ring of four segments. If two fingerprints differ in at most 3 bits, then
some segment starts a chain whose differences stay within budget all along: none in one segment, at most 1
in two, 2 in three, 3 in all four (floor of 3/4 per segment). The first two segments of a chain are the key
of a join: one side gives them as they are, the other with every bit of the second turned. What shares a
key goes through the rest of the chain and, if it gets to the end, the full check.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.batches import map_texts
from panelkit.llm.blocks import block_pairs, compare, forest
from panelkit.llm.components import components
from panelkit.sources.staging import stage

SHINGLE, DISTANCE = 3, 3
SEGMENTS, WIDTH = 4, 16
_SEED = 42
_CHUNK = 1 << 15
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a whole text as a signed 64-bit number; 0 without words.

    ASCII capitals are lowered, words are runs of characters other than ASCII white space, shingles are joined by
    spaces and count as often as they come. A text with fewer words is one shingle.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.r_[0, ends[:-1]][:n].tolist()
    stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for k in range(0, n, _CHUNK):
        spans = zip(starts[k : k + _CHUNK], stops[k : k + _CHUNK], strict=True)
        hashes = np.array([digest(joined[a:b], _SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text") -> DataFrame:
    """(doc_id, fp) of every whole text, ``fp`` as a bigint with the fingerprint's bits."""
    return map_texts(docs, lambda texts: [[fingerprint(t, shingle) for t in texts]], "fp bigint", text, ["doc_id"])


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, WIDTH * (i % SEGMENTS)).bitwiseAND(F.lit((1 << WIDTH) - 1))


def _chain(fp: Column, i: int) -> Column:
    """Key of the chain from segment ``i``: its number, the segment, the next segment in the lowest bits."""
    key = F.lit(i << 2 * WIDTH).cast("bigint").bitwiseOR(F.shiftleft(_segment(fp, i), WIDTH))
    return key.bitwiseOR(_segment(fp, i + 1))


def _check_chain(x: np.ndarray, y: np.ndarray, start: np.ndarray, distance: int) -> np.ndarray:
    """True where two fingerprints pass the chain from segment ``start`` and then the full check."""
    differ = x ^ y
    turn = (start * WIDTH).astype(np.uint64)
    ring = np.where(turn == 0, differ, (differ >> turn) | (differ << (np.uint64(64) - turn) % np.uint64(64)))
    near = np.ones(ring.shape, bool)
    for length in range(1, SEGMENTS):
        part = ring & np.uint64((1 << WIDTH * length) - 1)
        near &= np.bitwise_count(part) <= length * distance // SEGMENTS
    near[near] = np.bitwise_count(differ[near]) <= distance
    return near


def _load(group: pd.DataFrame) -> dict[str, np.ndarray]:
    return {
        "fp": group["fp"].to_numpy(np.int64).view(np.uint64),
        "id": group["fp"].to_numpy(np.int64),
        "start": (group["bucket"].to_numpy(np.int64) >> 2 * WIDTH),
    }


def _compare(distance: int) -> Callable:
    def each(data: dict[str, np.ndarray], rows: np.ndarray, others: np.ndarray | None) -> tuple[np.ndarray, ...]:
        others = rows if others is None else others
        x, y = np.broadcast_arrays(data["fp"][rows][:, None], data["fp"][others][None, :])
        linked = _check_chain(x, y, data["start"][rows][:, None], distance)
        low, low_other = forest(linked, data["id"][rows], data["id"][others])
        ids, low = np.r_[data["id"][rows], data["id"][others]], np.r_[low, low_other]
        return ids[ids != low], low[ids != low]

    return each


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(id, low): links between fingerprints that connect all of ``prints`` (distinct, ``fp``, a written table) that
    differ in ``distance`` bits or fewer. ``distance`` is at most 3, as the keys hold one turned bit."""
    if not 0 <= distance <= 3:
        raise ValueError(f"distance out of range: {distance}")
    fp = F.col("fp")
    whole = [_chain(fp, i) for i in range(SEGMENTS)]
    turned = [k.bitwiseXOR(F.lit(1 << b).cast("bigint")) for k in whole for b in range(WIDTH)]
    exact = stage(prints.select("fp", F.explode(F.array(*whole)).alias("bucket")), "chains")
    keys = stage(exact.select("bucket").distinct(), "keys")
    # most turned keys are no one's chain; they are dropped before anything is compared
    near = prints.select("fp", F.explode(F.array(*turned)).alias("bucket")).join(keys, "bucket", "left_semi")
    met = stage(exact.unionByName(near.select("fp", "bucket")), "met")
    return compare(block_pairs(met, "fp"), _load, _compare(distance), "id bigint, low bigint")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id, kept) for each document.

    Documents whose fingerprints differ in ``distance`` bits or fewer are linked; component_id is the smallest
    doc_id that links reach, ``kept`` marks the rows with that id. Null and empty texts have fingerprint zero and
    link like any other. Equal fingerprints are compared once. A null doc_id joins nothing: its component is
    null and it is kept. Rows that repeat an id get the component of their own text each. An empty table gives no rows.
    """
    hashed = stage(fingerprints(docs, shingle, text), "fingerprints")
    same = hashed.filter(F.col("doc_id").isNotNull()).groupBy("fp")
    prints = stage(same.agg(F.min("doc_id").alias("first")), "prints")
    parts = components(stage(links(prints, distance), "links"), "id", "low").withColumnRenamed("id", "fp")
    rooted = prints.join(parts, "fp", "left").select("fp", "first", F.coalesce("component_id", "fp").alias("root"))
    rooted = stage(rooted, "roots")
    least = stage(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    per_print = stage(rooted.join(least, "root").select("fp", "component_id"), "classes")
    known = hashed.join(per_print, "fp", "left")
    return known.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
