import datetime as dt

import pytest
from pyspark.sql import functions as F

from revenue_engine.functions.parsing import parse_amount, parse_date, reject_reason

D = dt.date


@pytest.mark.parametrize("s,expected", [
    ("2026-02-15", D(2026, 2, 15)),
    ("03/04/2026", D(2026, 4, 3)),        # day-first wins when ambiguous
    ("12/25/2025", D(2025, 12, 25)),      # day-first fails, month-first parses
    ("2026/02/15", D(2026, 2, 15)),
    ("15-02-2026", D(2026, 2, 15)),
    ("2026-2-5", None),                   # not zero-padded
    (" 2026-02-15", None),                # no trimming
    ("2026-02-30", None),                 # impossible calendar date
    ("2026-02-15 ", None),
    ("", None),
    ("n/a", None),
])
def test_parse_date(spark, s, expected):
    got = spark.createDataFrame([(s,)], "s string").select(parse_date("s").alias("d")).first().d
    assert got == expected


@pytest.mark.parametrize("s,expected", [
    ("1000.00", 1000.0), ("850", 850.0), ("-7.5", -7.5), ("+3", 3.0), (".5", 0.5), ("5.", 5.0),
    ("1e3", 1000.0), ("2.5E-1", 0.25),
    (" 7.5", None), ("7.5 ", None), ("1,000", None), ("", None), ("abc", None),
    ("NaN", None), ("Inf", None), ("0x1p3", None), ("1e400", None), ("1d", None),
])
def test_parse_amount(spark, s, expected):
    got = spark.createDataFrame([(s,)], "s string").select(parse_amount("s").alias("v")).first().v
    assert got == expected


def test_reason_order(spark):
    df = spark.createDataFrame(
        [(None, None, "", None), (D(2026, 1, 1), None, "", None), (D(2026, 1, 1), 1.0, "", None),
         (D(2026, 1, 1), 1.0, "EUR", None), (D(2026, 1, 1), 1.0, "EUR", 1.1)],
        "d date, v double, c string, r double")
    got = [r.reason for r in df.select(reject_reason("d", "v", "c", "r").alias("reason")).collect()]
    assert got == ["invalid_date", "invalid_revenue", "empty_currency", "no_rate", None]
