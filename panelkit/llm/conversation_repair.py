"""Repair of conversations whose turns are missing, empty, repeated, cut short or out of order.

Rows are put in order by ranges, so that a conversation of any length lies in consecutive blocks of at most BLOCK rows,
and only narrow rows take part: roles and faults, not texts. Each block tells what its rows of a conversation do to
the four states of a repair (``turn_edits``); these segments, one for BLOCK rows, are folded per conversation, and
the states at the borders that this settles let every block find its own edits by itself. Texts join
at the end, only those of lines that stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelkit.llm import turn_edits
from panelkit.sources.staging import stage

# Rows of a block, a power of two; bytes of the text that blocks of a long conversation hand on at a time.
BLOCK_BITS = 12
PIECE = 1 << 20
# White space, and what ends a sentence.
_BLANKS, _STOPS = " \t\n\x0b\x0c\r", [".", "!", "?"]
_ID = "conv_id"
_NONE, _BLANK, _DUPLICATE, _TRUNCATED = range(4)
_KIND = {_NONE: turn_edits.SOUND, _BLANK: turn_edits.UNWANTED, _DUPLICATE: turn_edits.UNWANTED, _TRUNCATED: turn_edits.CUT}
_LEGAL = {"su", "ua", "au"}
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _stream(df: DataFrame, make: Callable[[Iterator[tuple]], Iterator[tuple]], schema: StructType) -> DataFrame:
    """Rows that ``make`` gives for the rows of a partition in their order; it holds no more of them than it keeps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, target, strict=True)], schema=target)

        held, size = [], 0
        for row in make(r for b in batches for r in zip(*[c.to_pylist() for c in b.columns], strict=True)):
            held.append(row)
            size += sum(len(v) for v in row if isinstance(v, (bytes, str)))
            if len(held) >= 4096 or size >= 4 * PIECE:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)

    return df.mapInArrow(run, schema)


def _with(df: DataFrame, fields: str) -> StructType:
    """The type of the conversation's id, and ``fields`` behind it."""
    return StructType([df.schema[_ID], *StructType.fromDDL(fields).fields])


def _rows(conversations: DataFrame) -> DataFrame:
    """The four columns with nulls of role and text as one space, and the text's hash."""
    filled = conversations.select(
        _ID, "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    )
    return filled.withColumn("sha", F.unhex(F.sha2("text", 256)))


def ordered_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, sha, fault, initial, pos), written: every row at its place ``pos``.

    Places follow conversation, turn (null first), role and the text's hash, so rows of one turn have one order too. Rows that
    are equal in all of these are interchangeable and may lie in different blocks. A row's first fault counts: blank,
    a copy of an earlier row's role and text, or an end without a full stop.
    """
    rows = _rows(conversations)
    words = F.rtrim(F.col("text"), F.lit(_BLANKS))
    facts = {
        "initial": F.substring("role", 1, 1),
        "blank": words == "",
        "ended": F.right(words, F.lit(1)).isin(_STOPS),
    }
    narrow = rows.select(_ID, "turn", "role", "sha", *[v.alias(c) for c, v in facts.items()])
    narrow = narrow.withColumn("tie", F.monotonically_increasing_id())
    order = [_ID, "turn", "role", "sha", "tie"]
    ranged = narrow.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    # partition, then place in it: places grow along the order, and no block lies in two partitions
    placed = stage(ranged.withColumn("pos", F.monotonically_increasing_id()), "turns")
    first = placed.groupBy(_ID, "role", "sha").agg(F.min("pos").alias("pos"))
    told = placed.join(first.select("pos", F.lit(True).alias("is_first")), "pos", "left")
    fault = (
        F.when(F.col("blank"), _BLANK)
        .when(F.col("is_first").isNull(), _DUPLICATE)
        .when(~F.col("ended"), _TRUNCATED)
        .otherwise(_NONE)
    )
    return stage(told.select(_ID, "turn", "role", "sha", "initial", fault.alias("fault"), "pos"), "faults")


def _key() -> Column:
    """What tells a row by conversation, turn, role and text: one value, never null, so that texts move by it once."""
    place = F.to_json(F.struct(_ID, "turn", "role"), {"ignoreNullFields": "false"})
    return F.unhex(F.sha2(F.concat(place, F.hex("sha")), 256))


def _block(pos: str = "pos") -> Column:
    return F.shiftright(pos, BLOCK_BITS)


_SEGMENT = """block bigint, pos bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint,
first_initial string, last_initial string, first_turn bigint, last_turn bigint, turns bigint, totals array<bigint>,
costs array<bigint>, ranks array<bigint>"""


def _segments(rows: Iterator[tuple]) -> Iterator[tuple]:
    """A row for each conversation in each block: counts, its ends, and what it does to each state."""
    for (block, conv), group in groupby(rows, key=lambda r: (r[0], r[1])):
        part = [r[2:] for r in group]  # pos, turn, initial, fault
        faults = [r[3] for r in part]
        turns = [r[1] for r in part if r[1] is not None]
        pairs = zip(part, part[1:], strict=False)
        kinds = [turn_edits.row_kind(r[2], _KIND[r[3]]) for r in part]
        ways = turn_edits.segment(kinds)
        yield (
            conv, block, part[0][0], *[faults.count(f) for f in (_BLANK, _DUPLICATE, _TRUNCATED)],
            sum(a[2] + b[2] not in _LEGAL for a, b in pairs), part[0][2], part[-1][2],
            turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)),
            [total for total, _ in ways], [c for _, v in ways for c in v[0]], [r for _, v in ways for r in v[1]],
        )


_PATH = """block bigint, pos bigint, before int, behind int, tail int, n_segments bigint,
gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"""


def _paths(rows: Iterator[tuple]) -> Iterator[tuple]:
    """For each segment the states at its ends; the first one of a conversation carries the counts of all."""
    known: dict = {}  # few different segments occur, so that long conversations hold little
    for conv, group in groupby(rows, key=lambda r: r[0]):
        places, ways = [], []
        sums, illegal, turns = [0, 0, 0], 0, 0
        last, first_turn, last_turn = None, None, None
        total, vector = 0, turn_edits.alone(turn_edits.START)
        for _, block, pos, blank, duplicate, truncated, odd, head, tail, low, high, n, totals, costs, ranks in group:
            part = tuple((totals[s], (tuple(costs[4 * s : 4 * s + 4]), tuple(ranks[4 * s : 4 * s + 4]))) for s in range(4))
            part = known.setdefault(part, part)
            cost, vector = turn_edits.forward_segment(vector, part)
            total += cost
            places.append((block, pos))
            ways.append(part)
            sums = [a + b for a, b in zip(sums, (blank, duplicate, truncated), strict=True)]
            illegal += odd + (last is not None and last + head not in _LEGAL)
            last = tail
            if n:
                turns += n - (low == last_turn)
                first_turn, last_turn = low if first_turn is None else first_turn, high
        gaps = 0 if first_turn is None else last_turn - first_turn + 1 - turns
        cost, end = turn_edits.best_end(total, vector)
        if len(known) > 10_000:
            known.clear()
        between = turn_edits.crossings(
            ways, turn_edits.START, end, turn_edits.forward_segment, turn_edits.backward_segment
        )
        for k, ((block, pos), (s, t)) in enumerate(zip(places, between, strict=True)):
            inserts = turn_edits.TAIL[end] if k == len(places) - 1 else 0
            counts = [gaps, *sums, illegal, cost] if k == 0 else [None] * 6
            yield (conv, block, pos, s, t, inserts, len(places), *counts)


_EDITS = "pos bigint, audit string, long boolean, head string, role_out string, tail string, key binary"


def _text_of(roles: list[str]) -> str | None:
    """Lines of inserted turns."""
    return "\n".join(f"{r}:" for r in roles) or None


def _edits(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The letters of each row's edits, the lines inserted before it and, at the end of a conversation, behind it; of a row
    that stays the role of its line and its key. A segment's states come before its rows."""
    for (_, conv, _), group in groupby(_told(rows), key=lambda r: (r[0], r[1], r[2])):
        part = [r[3:] for r in group]
        (s, t, inserts, n_segments), places = part[0][:4], part[1:]
        kinds = [turn_edits.row_kind(initial, _KIND[fault]) for _, initial, fault, _, _ in places]
        for i, ((pos, _, _, own, key), kind) in enumerate(zip(places, kinds, strict=True)):
            if i == 0:
                ways = turn_edits.crossings(kinds, s, t)
            a, b = next(ways)
            audit = turn_edits.moves(kind)[a, b][1]
            made = list(turn_edits.lines(a, audit))
            role = {"K": own, "R": made[-1][1], "D": None}[audit[-1]]
            closing = "I" * inserts if i == len(places) - 1 else ""
            behind = [r for _, r in turn_edits.lines(b, closing)]
            head, tail = _text_of([r for _, r in made[:-1]]), _text_of(behind)
            yield conv, pos, audit + closing, n_segments > 1, head, role, tail, None if role is None else key


def _told(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows with the block, conversation and number of their segment; the row of its states is the first."""
    number = 0
    for block, conv, pos, is_row, initial, fault, role, key, before, behind, tail, n_segments in rows:
        if not is_row:
            number += 1
            yield block, conv, number, before, behind, tail, n_segments
        else:
            yield block, conv, number, pos, initial, fault, role, key


class Repair:
    """The cheapest repair of each conversation.

    Columns ``conv_id``, ``turn`` (whole number), ``role`` and ``text`` are used, whatever others there are. Null roles and
    texts are one space, a null id is a conversation like others, null turns come first; rows that repeat a turn follow
    each other by role and a hash of the text. Faults of a row, the first counts: blank, same role and text as an
    earlier row, no full stop at its end. Edits: ``turn_edits``. Blank and repeated rows have to go.

    ``report``: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), a row for each
    conversation. ``lines``: (conv_id, pos, data), the repaired lines ``role:text`` that a row leaves, with the
    inserted lines around it; in the order of ``pos`` they are the repaired conversation. An empty table
    has no rows in either.

    A conversation's audit and hash are one cell each: its edits and lines stream through one task, in blocks, which
    holds the audit but never the text.
    """

    def __init__(self, conversations: DataFrame):
        rows = ordered_rows(conversations)
        narrow = rows.select(_block().alias("block"), _ID, "pos", "turn", "initial", "fault")
        by_block = narrow.select("block", _ID, "pos", F.col("turn").cast("bigint").alias("turn"), "initial", "fault")
        by_block = by_block.repartition("block").sortWithinPartitions("block", "pos")
        segments = _stream(by_block, _segments, _with(rows, _SEGMENT))
        by_conversation = segments.repartition(_ID).sortWithinPartitions(_ID, "block")
        self.paths = stage(_stream(by_conversation, _paths, _with(rows, _PATH)), "paths")
        self.rows, self.conversations = rows, conversations
        self.lines, self._pieces = self._joined()

    def _joined(self) -> tuple[DataFrame, DataFrame]:
        states = ["before", "behind", "tail", "n_segments"]
        told = self.paths.select("block", _ID, "pos", F.lit(False).alias("is_row"), *states)
        own = ["initial", "fault", "role", "key"]
        rows = self.rows.withColumn("key", _key()).select(_block().alias("block"), _ID, "pos", F.lit(True).alias("is_row"), *own)
        both = rows.unionByName(told, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "pos", "is_row")
        names = ["block", _ID, "pos", "is_row", *own, *states]
        edits = stage(_stream(both.select(*names), _edits, _with(self.rows, _EDITS)), "edits")
        # a line that stays is the only one of its conversation with this role and text; equal rows have one text
        texts = _rows(self.conversations).select(_key().alias("key"), "text").dropDuplicates(["key"])
        kept = edits.filter(F.col("key").isNotNull()).join(texts, "key")
        gone = edits.filter(F.col("key").isNull())
        line = F.concat("role_out", F.lit(":"), "text")
        said = kept.select(_ID, "pos", "audit", "long", F.concat_ws("\n", "head", line, "tail").alias("data"))
        rest = F.when(F.coalesce("head", "tail").isNotNull(), F.concat_ws("\n", "head", "tail"))
        pieces = said.unionByName(gone.select(_ID, "pos", "audit", "long", rest.alias("data")))
        return pieces.filter(F.col("data").isNotNull()).select(_ID, "pos", "data"), pieces

    @property
    def report(self) -> DataFrame:
        schema = _with(self.rows, "pos bigint, audit string, long boolean, data string")
        # blocks of long conversations put their own rows together first
        long = self._pieces.filter("long").repartition(_block()).sortWithinPartitions("pos")
        pieces = self._pieces.filter("not long").unionByName(_stream(long, _merged, schema))
        ordered = pieces.select(_ID, "audit", "data", "pos").repartition(_ID).sortWithinPartitions(_ID, "pos")
        hashed = _stream(ordered, _hashed, _with(self.rows, "audit string, repaired_sha256 string"))
        counts = self.paths.filter(F.col("cost").isNotNull()).select(_ID, *COUNTS)
        return counts.join(hashed.withColumnRenamed(_ID, "__id"), F.col(_ID).eqNullSafe(F.col("__id"))).drop("__id")


def _merged(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Pieces of consecutive rows of a conversation in a block; a piece ends when it is large."""
    for (conv, _), group in groupby(rows, key=lambda r: (r[0], r[1] >> BLOCK_BITS)):
        audit, data, size, start = [], [], 0, None
        for _, pos, letters, _, text in group:
            start = pos if start is None else start
            audit.append(letters)
            if text is not None:
                data.append(text)
                size += len(text)
            if size >= PIECE:
                yield conv, start, "".join(audit), True, "\n".join(data)
                audit, data, size, start = [], [], 0, None
        if start is not None:
            yield conv, start, "".join(audit), True, "\n".join(data) if data else None


def _hashed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Audit and hash of each conversation, of its pieces in order."""
    for conv, group in groupby(rows, key=lambda r: r[0]):
        audit, digest, started = [], hashlib.sha256(), False
        for _, letters, data, _ in group:
            audit.append(letters)
            if data is not None:
                digest.update((("\n" if started else "") + data).encode())
                started = True
        yield conv, "".join(audit), digest.hexdigest()
