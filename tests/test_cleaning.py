"""P4-P9, P17 on the reference's duration fixture plus the edge cases it lacks."""

import pytest
from pyspark.sql import functions as F

from tabready.functions import cleaning as C
from tabready.functions.arithmetic import negated_score_to_error, percent_change


def _one(spark, values, expr, schema="value string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr(F.col("value"))).collect()]


def test_duration_text(spark):
    out = _one(spark, ["120", "4:30", "1:02:03", None], C.parse_numeric_or_time)
    assert out == [120.0, 270.0, 3723.0, None]


@pytest.mark.parametrize("text,expected", [
    ("1,200", 1200.0), ("1e3", 1000.0), ("  12 ", 12.0), ("+5", 5.0), (".5", 0.5),
    ("inf", None), ("10d", None), ("1_000", None), ("NaN", None), ("nan", None), ("none", None), ("", None),
    ("4:75", 315.0), ("4:300", None), ("\t7\n", 7.0),
])
def test_parse_edge_cases(spark, text, expected):
    assert _one(spark, [text], C.parse_numeric_or_time) == [expected]


def test_numeric_passthrough_nan_to_null(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "value double")
    out = [r[0] for r in df.select(C.parse_numeric_or_time("value", is_numeric=True)).collect()]
    assert out == [1.5, None, None]


def test_clock_to_seconds(spark):
    assert _one(spark, ["4:30", "1:02:03", "5", "1:2:3:4"], C.clock_to_seconds) == [270.0, 3723.0, None, None]


def test_clean_categorical(spark):
    out = _one(spark, [" Male ", "--", "None", "", "NULL", None, "FEMALE"], C.clean_categorical)
    assert out == ["male", "--", None, None, None, None, "female"]


def test_ranges_positive_sentinels(spark):
    df = spark.createDataFrame([(v,) for v in [-1.0, 0.0, 1.0, 5.0, 10.0, None]], "value double")
    rows = df.select(
        C.null_out_of_range("value", 0.0, 5.0).alias("r"),
        C.null_out_of_range("value", None, 5.0).alias("hi_only"),
        C.null_non_positive("value").alias("p"),
        C.null_sentinels("value", [1.0, 10.0]).alias("s"),
    ).collect()
    assert [r.r for r in rows] == [None, 0.0, 1.0, 5.0, None, None]
    assert [r.hi_only for r in rows] == [-1.0, 0.0, 1.0, 5.0, None, None]
    assert [r.p for r in rows] == [None, None, 1.0, 5.0, 10.0, None]
    assert [r.s for r in rows] == [-1.0, 0.0, None, 5.0, None, None]


def test_safe_float_and_negated_score(spark):
    assert _one(spark, ["3.5", "x", None], C.safe_float) == [3.5, None, None]
    assert _one(spark, ["-160", "abc"], negated_score_to_error) == [160.0, None]


def test_percent_change(spark):
    df = spark.createDataFrame([(90.0, 100.0)], "new double, ref double")
    assert df.select(percent_change("new", "ref")).first()[0] == pytest.approx(-10.0)
    zero = spark.createDataFrame([(90.0, 0.0)], "new double, ref double")
    assert zero.select(percent_change("new", "ref", strict=False)).first()[0] is None
    with pytest.raises(Exception, match="from zero"):
        zero.select(percent_change("new", "ref")).collect()
