"""Month keys, date re-formatting, lenient numbers."""

import random

import pytest
from pyspark.sql import functions as F

from panelkit.functions import month_key, reformat_date, to_int, with_period


def _column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    col = expr(df) if callable(expr) else expr
    return [r[0] for r in df.select(col.alias("o"), "i").orderBy("i").select("o").collect()]


def test_month_key(spark):
    texts = ["20230115", "20231231", "20230230", "20231301", "2023-01-15", "2023011", "garbage", "", None, "202301150"]
    want = ["202301", "202312"] + [None] * 8
    assert _column(spark, texts, month_key("c")) == want


def test_blanks_and_trailing_letters_are_no_dates(spark):
    texts = ["2023011T", "2023011 ", " 0230115", "2023 115", "20230 15", "202301 5", "+0230115", "-0230115", "00000101"]
    assert _column(spark, texts, month_key("c")) == [None] * len(texts)


def test_reformat(spark):
    texts = ["2023-01-05", "2023-1-5", "20230105", "2023/01/05", "2023-02-29", "2024-02-29", None]
    want = ["20230105", None, None, None, None, "20240229", None]
    assert _column(spark, texts, reformat_date("c", "yyyy-MM-dd", "yyyyMMdd")) == want


def test_formats_without_fixed_places(spark):
    texts = ["5 Jan 2023", "31 Feb 2023", "x", None]
    assert _column(spark, texts, month_key("c", "d MMM yyyy")) == ["202301", None, None, None]
    assert _column(spark, ["20230105"], reformat_date("c", "yyyyMMdd", "dd MMM yyyy")) == ["05 Jan 2023"]


@pytest.mark.parametrize("fmt", ["yyyyMMdd", "yyyy-MM-dd", "dd/MM/yyyy", "MM.dd.yyyy"])
def test_fixed_width_parsing_agrees_with_the_date_parser(spark, fmt):
    rng = random.Random(7)
    texts = []
    for _ in range(3000):
        y, m, d = rng.randint(1, 2999), rng.randint(0, 13), rng.randint(0, 32)
        text = list(fmt.replace("yyyy", f"{y:04}").replace("MM", f"{m:02}").replace("dd", f"{d:02}"))
        if rng.random() < 0.3:
            text[rng.randrange(len(text))] = rng.choice("0123456789 T-/.+x\t")
        texts.append("".join(text))
    slow = F.date_format(F.try_to_date("c", fmt), "yyyyMM")
    assert _column(spark, texts, month_key("c", fmt)) == _column(spark, texts, slow)


def test_with_period_keeps_columns(spark):
    df = spark.createDataFrame([("20230115", 1)], "yyyymmdd string, x int")
    assert with_period(df).collect() == [("20230115", 1, "202301")]


def test_to_int_from_text(spark):
    texts = ["12", "12.7", "-12.7", " 5 ", "x", "", None, "99999999999", "1e3", "12d", "12.a", "2147483647", ".5", "7."]
    want = [12, 12, -12, 5, None, None, None, None, None, None, None, 2147483647, 0, 7]
    assert _column(spark, texts, lambda df: to_int(df, "c")) == want


def test_to_int_from_numbers(spark):
    assert _column(spark, [1.9, -1.9, 1e12, None], lambda df: to_int(df, "c"), "double") == [1, -1, None, None]
    assert _column(spark, [3, 2**40], lambda df: to_int(df, "c"), "bigint") == [3, None]
