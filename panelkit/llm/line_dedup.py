"""Removal of lines that repeat an earlier line up to one edit, by a deletion-neighbourhood join.

Two lines are within one edit if one is the other with a character taken out, or both become equal when the
character at one place is taken out. So each line emits, as hashed keys, itself and every variant with one
character deleted; lines that share a key are joined with the earliest of them, and the edit distance is checked.

Three things keep that small. Equal lines are one line from the start. A line enters the join only if another of
about its length shares its first or its last half, as an edit leaves one half alone. And a line is cut into blocks: a
variant is hashed as the text before a block, the block without one character, the text behind; only blocks
around which another line is the same emit variants.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.sources.staging import stage

# Shorter lines are not compared up to an edit; characters of a block; rows of a table that may be broadcast.
MIN_CHARS, BLOCK, BROADCAST_ROWS = 20, 64, 500_000
_END = "\n"


def _small(table: DataFrame) -> DataFrame:
    """A written table of narrow rows, to be broadcast if it has BROADCAST_ROWS rows at most; else it is shuffled."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _halves() -> Column:
    """Hashes of the first and last half of ``line``. Lengths 2c - 1 to 2c + 1 are a class with halves of c - 1
    characters, so two lines whose lengths differ by one share a class."""
    n = F.length("line")
    classes = F.array_distinct(F.array(F.floor(n / 2), F.floor((n + 1) / 2)))

    def ends(c: Column) -> Column:
        half = (c - 1).cast("int")
        return F.array(
            F.xxhash64(F.lit("head"), c, F.substring(F.col("line"), F.lit(1), half)),
            F.xxhash64(F.lit("tail"), c, F.substring(F.col("line"), n - half + 1, half)),
        )

    return F.flatten(F.transform(classes, ends))


def split_lines(docs: DataFrame, text: str = "text", short: bool = False) -> DataFrame:
    """(place, id, line): the lines of MIN_CHARS characters or more, cut at line feeds only; with ``short`` also the
    shorter ones that have a word.

    ``place`` orders all lines: by document, null ids last, rows that repeat an id by a hash of their texts, then by
    position. ``id`` is a 128-bit hash of the line.
    """
    cut = docs.select("doc_id", F.xxhash64(f"`{text}`").alias("row"), F.posexplode(F.split(f"`{text}`", _END)).alias("pos", "line"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "pos")
    wanted = F.length("line") >= MIN_CHARS
    wanted = wanted | F.col("line").rlike(r"\S") if short else wanted
    return cut.filter(wanted).select(place.alias("place"), F.unhex(F.md5("line")).alias("id"), "line")


def distinct_lines(lines: DataFrame) -> DataFrame:
    """(id, first, n, anchors): each distinct line of (place, id, anchors), where it is found first and how often."""
    return lines.groupBy("id").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n"), F.any_value("anchors").alias("anchors")
    )


def _candidates(known: DataFrame, lines: DataFrame) -> DataFrame:
    """(id, first, line) of the distinct lines that share a half with another line of about their length."""
    anchors = known.select("id", F.explode("anchors").alias("anchor"))
    shared = anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    ids = anchors.join(stage(shared, "anchors"), "anchor", "left_semi").select("id").distinct()
    chosen = stage(known.join(ids, "id", "left_semi").select("id", "first"), "chosen")
    texts = lines.join(_small(chosen), "id").filter(F.col("place") == F.col("first"))
    return texts.groupBy("id", "first").agg(F.any_value("line").alias("line"))


def _blocks(lines: DataFrame) -> DataFrame:
    """(id, first, start, block, head, tail, tail_of_whole): each block of each line, with hashes of what is around it.

    ``tail_of_whole`` begins one character earlier: there a longer line goes on from which a character of that block
    was deleted, while this one stays whole.
    """
    size, n = F.lit(BLOCK), F.length("line")
    line, start = F.col("line"), F.col("start")
    return lines.withColumn("start", F.explode(F.sequence(F.lit(0), n, size))).select(
        "id",
        "first",
        "start",
        F.substring(line, start + 1, size).alias("block"),
        F.xxhash64(F.substring(line, F.lit(1), start)).alias("head"),
        F.xxhash64(F.substring(line, start + size + 1, n)).alias("tail"),
        F.xxhash64(F.substring(line, start + size, n)).alias("tail_of_whole"),
    )


def _shared_blocks(blocks: DataFrame) -> DataFrame:
    """Those of ``blocks`` (a written table) around which another line is the same: the edit can only lie there."""
    around = [F.xxhash64("start", "head", c) for c in ("tail", "tail_of_whole")]
    keys = blocks.select("id", "start", F.explode(F.array_distinct(F.array(*around))).alias("around"))
    shared = keys.groupBy("around").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("around")
    met = keys.join(stage(shared, "around"), "around", "left_semi").select("id", "start").distinct()
    return blocks.join(met, ["id", "start"], "left_semi")


def variants(lines: DataFrame) -> DataFrame:
    """(id, first, key, at): hashed keys of the variants that another line can share; ``at`` is the place of the deleted
    character, -1 in the line itself."""
    block, width = F.col("block"), F.length("block")
    # the last place of a block stands for the line itself
    each = _shared_blocks(stage(_blocks(lines), "blocks")).withColumn("j", F.explode(F.sequence(F.lit(0), width)))
    j, whole = F.col("j"), F.col("j") == width
    without = F.concat(F.substring(block, F.lit(1), j), F.substring(block, j + 2, width))
    kept = F.when(whole, F.substring(block, F.lit(1), F.lit(BLOCK - 1))).otherwise(without)
    tail = F.when(whole, F.col("tail_of_whole")).otherwise(F.col("tail"))
    return each.select(
        "id",
        "first",
        F.xxhash64("start", "head", kept, tail).alias("key"),
        F.when(whole, -1).otherwise(F.col("start") + j).alias("at"),
    )


def _earlier(keys: DataFrame) -> DataFrame:
    """(id, other): for each row of ``keys``, a written table, the earliest line that its key allows, if it is earlier.

    A deletion meets the earliest line with the same place deleted, or the whole line with its key; a whole
    line meets the earliest deletion. So every row is joined with one row at most, however many share a key.
    A key has a row for each place of one block at most.
    """
    by_place = keys.groupBy("key", "at").agg(F.min(F.struct("first", "id")).alias("best"))
    whole = F.min(F.when(F.col("at") < 0, F.col("best"))).alias("whole")
    deleted = F.min(F.when(F.col("at") >= 0, F.col("best"))).alias("deleted")
    by_key = by_place.groupBy("key").agg(whole, deleted, F.collect_list(F.struct("at", "best")).alias("places"))
    best = by_key.select("key", "whole", "deleted", F.inline("places"))
    best = best.select(
        "key", "at", F.when(F.col("at") < 0, F.col("deleted")).otherwise(F.least("best", "whole")).alias("best")
    )
    met = keys.join(stage(best.filter("best is not null"), "best"), ["key", "at"])
    return met.filter(F.col("best.first") < F.col("first")).select("id", F.col("best.id").alias("other")).distinct()


def near_lines(known: DataFrame, lines: DataFrame) -> DataFrame:
    """(id) of the distinct lines that are within one edit of an earlier line."""
    chosen = stage(_candidates(known, lines), "candidates")
    pairs = stage(_earlier(stage(variants(chosen), "variants")), "pairs")
    mine, others = chosen.select("id", "line"), chosen.select(F.col("id").alias("other"), F.col("line").alias("earlier"))
    checked = pairs.join(mine, "id").join(others, "other")
    return checked.filter(F.levenshtein("line", "earlier", 1) >= 0).select("id").distinct()


def dropped_lines(docs: DataFrame, text: str = "text", short: bool = False) -> DataFrame:
    """(doc_id, row, dropped): positions of the lines to drop, for documents that have any. Texts are cut here once for
    the lines' hashes and places, which are written, and once for the texts of lines that may be near another."""
    lines = split_lines(docs, text, short)
    # no halves (null) of a line under MIN_CHARS characters, which so never enters the join
    halves = F.when(F.length("line") >= MIN_CHARS, _halves()).alias("anchors")
    places = stage(lines.select("place", "id", halves), "places")
    known = stage(distinct_lines(places), "lines")
    near = near_lines(known, lines).withColumn("near", F.lit(True))
    again = known.join(near, "id", "left").select("id", "first", "n", F.coalesce("near", F.lit(False)).alias("near"))
    again = stage(again.filter("near or n > 1").drop("n"), "repeated")
    gone = places.select("place", "id").join(_small(again), "id").filter(F.col("near") | (F.col("place") > F.col("first")))
    by_row = gone.groupBy(F.col("place.doc_id").alias("doc_id"), F.col("place.row").alias("row"))
    return by_row.agg(F.collect_set("place.pos").alias("dropped"))


def dedup_lines(docs: DataFrame, text: str = "text", short: bool = False) -> DataFrame:
    """The documents with ``n_lines`` and ``n_dropped`` beside their columns, and the dropped lines taken out of
    ``text``; the rest of the lines stay in order, a document without any left gets an empty text.

    A line of MIN_CHARS characters or more is dropped if an earlier line of any document, or of its own, is equal to
    it or one edit (a character inserted, deleted or replaced) away. With ``short``, a shorter line that has a word is
    dropped if an earlier line is equal to it; without, shorter lines stay. Earlier means a smaller doc_id (null last), then
    a smaller position; whether that line is dropped itself does not matter. Rows that repeat an id come in the order
    of a hash of their texts; rows that repeat id and text share their lines' places, so all of them keep the same
    lines. Null texts stay null and have no lines. Columns named n_lines or n_dropped are replaced. An empty table
    gives no rows.
    """
    gone = dropped_lines(docs, text, short).select(
        F.col("doc_id").alias("__id"), F.col("row").alias("__row"), F.col("dropped").alias("__dropped")
    )
    gone = _small(stage(gone, "gone"))
    body = F.col(f"`{text}`")
    same = body.isNotNull() & docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(body) == F.col("__row"))
    # cut in a step of its own: what follows uses the lines several times
    joined = docs.join(gone, same, "left").withColumn("__lines", F.when(F.col("__dropped").isNotNull(), F.split(body, _END)))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__dropped"))
    rest = F.array_join(F.transform(kept, lambda i: F.col("__lines")[i]), _END)
    counts = {
        "n_lines": F.coalesce(F.length(body) - F.length(F.replace(body, F.lit(_END))) + 1, F.lit(0)).cast("bigint"),
        "n_dropped": F.when(F.col("__dropped").isNull(), 0).otherwise(F.size("__dropped")).cast("bigint"),
    }
    changed = {text: F.when(F.col("__dropped").isNull(), body).otherwise(rest)}
    return joined.withColumns(counts | changed).drop("__id", "__row", "__dropped", "__lines")
