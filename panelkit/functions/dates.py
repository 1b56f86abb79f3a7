"""Dates kept as text: month keys and re-formatting.

Text that is not a date in the given format gives null, with ANSI mode on or off.

A format made of ``yyyy``, ``MM`` and ``dd`` once each plus separators has every
part at a fixed place, so the parts are cut out with ``substring`` and checked by
one cast to date. That is several times cheaper per row than running a date
formatter twice, and these expressions see every raw row. Any other format goes
through ``try_to_date`` and ``date_format``.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The periods that a key may name.
GRAINS = ("week", "month", "quarter", "year")
_FIXED = re.compile(r"(yyyy|MM|dd|[-/._: ])")


def _layout(fmt: str) -> list[str] | None:
    """Pieces of a fixed-width format, or None when it is not one."""
    pieces = _FIXED.findall(fmt)
    if "".join(pieces) != fmt:
        return None
    fields = sorted(p for p in pieces if p.isalpha())
    return pieces if fields == ["MM", "dd", "yyyy"] else None


def _as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _parse_fixed(text: Column, pieces: list[str]) -> tuple[Column, dict[str, Column]]:
    """(is this a date, its parts as text) for a fixed-width format."""
    parts, seps, at = {}, [], 1
    for piece in pieces:
        cut = F.substring(text, at, len(piece))
        if piece.isalpha():
            parts[piece] = cut
        else:
            seps.append(cut == piece)
        at += len(piece)
    iso = F.concat_ws("-", parts["yyyy"], parts["MM"], parts["dd"])
    checks = [
        F.length(text) == at - 1,
        *seps,
        parts["yyyy"] > "0000",
        # the cast forgives blanks and a 'T' after the day, a strict format does not
        F.substring(parts["dd"], 2, 1).between("0", "9"),
        iso.try_cast("date").isNotNull(),
    ]
    return reduce(Column.__and__, checks), parts


def reformat_date(col: Column | str, src: str, dst: str) -> Column:
    """Date text in format ``src`` written in format ``dst``; null when not a date."""
    text = _as_column(col)
    src_pieces = _layout(src)
    dst_pieces = re.findall(r"yyyy|MM|dd|[-/._: ]", dst)
    if src_pieces is None or "".join(dst_pieces) != dst:
        return F.date_format(F.try_to_date(text, src), dst)
    is_date, parts = _parse_fixed(text, src_pieces)
    return F.when(is_date, F.concat(*[parts.get(p, F.lit(p)) for p in dst_pieces]))


def month_key(col: Column | str, fmt: str = "yyyyMMdd") -> Column:
    """Zero-padded ``yyyyMM`` text of a date text, so that text order is time order."""
    return reformat_date(col, fmt, "yyyyMM")


def _quarter(month: Column) -> Column:
    return F.concat(F.lit("Q"), F.ceil(month.try_cast("int") / 3).cast("string"))


def _week(date: Column) -> Column:
    """ISO week with the year that it counts to."""
    year = F.extract(F.lit("YEAROFWEEK"), date).cast("string")
    return F.concat(F.lpad(year, 4, "0"), F.lit("W"), F.lpad(F.weekofyear(date).cast("string"), 2, "0"))


def period_key(col: Column | str, fmt: str = "yyyyMMdd", grain: str = "month") -> Column:
    """Key of a date text's week ('2023W05', ISO), month ('202302'), quarter ('2023Q1') or year ('2023').

    Keys of one grain are in the order of time; null where the text is no date.
    """
    if grain == "month":
        return month_key(col, fmt)
    if grain not in GRAINS:
        raise ValueError(f"unknown grain: {grain}")
    text, pieces = _as_column(col), _layout(fmt)
    if pieces is None:
        date = F.try_to_date(text, fmt)
        year, month, is_date = F.date_format(date, "yyyy"), F.date_format(date, "MM"), date.isNotNull()
    else:
        is_date, parts = _parse_fixed(text, pieces)
        year, month = parts["yyyy"], parts["MM"]
        date = F.concat_ws("-", year, month, parts["dd"]).try_cast("date")
    key = {"week": lambda: _week(date), "quarter": lambda: F.concat(year, _quarter(month)), "year": lambda: year}[grain]()
    return F.when(is_date, key)


def coarser(month: Column | str, grain: str) -> Column:
    """The quarter or year of a month key. Weeks cross the ends of months, so no other key tells them."""
    key = _as_column(month)
    if grain == "quarter":
        return F.concat(F.substring(key, 1, 4), _quarter(F.substring(key, 5, 2)))
    if grain in ("month", "year"):
        return key if grain == "month" else F.substring(key, 1, 4)
    raise ValueError(f"a month has no {grain}")


def with_period(
    df: DataFrame, date_col: str = "yyyymmdd", fmt: str = "yyyyMMdd", out: str = "yyyymm", grain: str = "month"
) -> DataFrame:
    """Add the period key of a date text column, by default its month."""
    return df.withColumn(out, period_key(date_col, fmt, grain))
