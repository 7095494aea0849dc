"""The content digest tells apart copies that row counts do not."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from shelfwise.operators.digest import COLUMNS, column_digest

SCHEMA = "a string, b string, n int, x double, ok boolean, d date"
ROWS = [(" p ", "q", 1, 0.1, True, dt.date(2024, 1, 2)), ("", None, 2, 0.2, False, None),
        (None, "two\nlines", None, None, None, dt.date(2024, 1, 1))]


def _digest(df):
    return {r["column_no"]: tuple(r) for r in column_digest(df).collect()}


def test_values(spark):
    got = _digest(spark.createDataFrame(ROWS, SCHEMA))
    assert column_digest(spark.createDataFrame(ROWS, SCHEMA)).columns == list(COLUMNS)
    assert got == {
        0: (0, 3, 2, "3", "", " p "), 1: (1, 3, 2, "10", "q", "two\nlines"), 2: (2, 3, 2, "3", None, None),
        3: (3, 3, 2, "3000", None, None), 4: (4, 3, 2, "1", None, None),
        5: (5, 3, 2, None, "2024-01-01", "2024-01-02")}


def test_shifted_trimmed_and_lost_values_show(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    base = _digest(frame)
    for changed in (frame.select("b", "a", "n", "x", "ok", "d"),
                    frame.selectExpr("trim(a) AS a", "b", "n", "x", "ok", "d"),
                    frame.selectExpr("nullif(a, '') AS a", "b", "n", "x", "ok", "d"),
                    frame.selectExpr("a", "b", "n", "x + 0.001 AS x", "ok", "d")):
        assert _digest(changed) != base


def test_empty_table(spark):
    got = _digest(spark.createDataFrame([], SCHEMA))
    assert all(r == (i, 0, 0, None, None, None) for i, r in got.items()) and len(got) == 6


def test_totals_of_doubles_round_as_decimals_do(spark):
    """Whole numbers in BIGINT give the text of DECIMAL sums, beyond their range too."""
    odd = [0.00005, -0.00005, 0.00015, 0.000049999999999999996, 123456.78905, -0.0, 1e-300, 901.50555, 1e11, 450359962737.0496,
           -450359962737.0497, 3e14, -7e15, None, 12.34565, 0.1 + 0.2]
    for some in (odd, odd[:10], [3e14], [None], [-0.00004], [-1.5, 0.25]):
        frame = spark.createDataFrame([(x,) for x in some], "x double")
        want = frame.agg(F.sum(F.round(F.col("x") * 10_000).cast("decimal(20,0)")).cast("string")).first()[0]
        assert _digest(frame)[0][3] == want
