"""Bounded exact quantiles equal Spark's ``percentile`` on every path:
straight to ranking, a few narrowing passes, and many passes with ties."""

import pytest
from pyspark.sql import functions as F

from tabready.operators.quantiles import exact_quantiles


def skewed(spark):
    df = spark.range(6000).select(
        (F.col("id") % 3).alias("g"),
        (F.pow(F.col("id") % 977, 1.5) * F.when(F.col("id") % 5 == 0, 1).otherwise(0.37)).alias("v"))
    # one value holding a third of group 1
    return df.union(spark.range(2000).select(F.lit(1).cast("long").alias("g"), F.lit(42.0).alias("v")))


@pytest.mark.parametrize("final_rows,buckets", [(1 << 16, 4096), (50, 8), (5, 4)])
def test_grouped_matches_percentile(spark, final_rows, buckets):
    df = skewed(spark)
    got = exact_quantiles(df, "v", [0.5, 0.99, 0.1], ["g"], buckets=buckets, final_rows=final_rows) \
        .orderBy("g").collect()
    want = df.groupBy("g").agg(*[F.percentile("v", p).alias(f"q_{p}") for p in (0.5, 0.99, 0.1)]) \
        .orderBy("g").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


@pytest.mark.parametrize("final_rows,buckets", [(1 << 16, 4096), (7, 4)])
def test_global_matches_percentile(spark, final_rows, buckets):
    df = skewed(spark)
    got = exact_quantiles(df, "v", [0.5], buckets=buckets, final_rows=final_rows).first()[0]
    assert got == df.agg(F.percentile("v", 0.5)).first()[0]


def test_nulls_ignored_and_empty_group_absent(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", None)], "g string, v double")
    rows = {r.g: r.m for r in exact_quantiles(df, "v", [0.5], ["g"], names=["m"]).collect()}
    assert rows == {"a": 2.0}


def test_aggregate_with_quantiles_shares_the_pass(spark):
    from tabready.operators.quantiles import aggregate_with_quantiles

    df = skewed(spark).union(spark.createDataFrame([(7, None)], "g long, v double"))
    got = aggregate_with_quantiles(df, F.col("v"), [F.count(F.lit(1)).alias("rows")], [0.5, 0.99],
                                   ["med", "p99"], ["g"]).orderBy("g").collect()
    want = df.groupBy("g").agg(F.count(F.lit(1)).alias("rows"), F.percentile("v", 0.5).alias("med"),
                               F.percentile("v", 0.99).alias("p99")).orderBy("g").collect()
    assert [r.asDict() for r in got] == [r.asDict() for r in want]
    one = aggregate_with_quantiles(df, F.col("v") * 2, [F.max("v").alias("top")], [0.5], ["med"]).collect()
    assert len(one) == 1 and one[0]["med"] == df.agg(F.percentile(F.col("v") * 2, 0.5)).first()[0]


@pytest.mark.parametrize("by", [["g"], []])
def test_materialized_passes_match(spark, by):
    df = skewed(spark)
    got = exact_quantiles(df, "v", [0.5, 0.99], by, buckets=4, final_rows=9, materialize=True)
    want = (df.groupBy(*by) if by else df.groupBy()).agg(
        *[F.percentile("v", p).alias(f"q_{p}") for p in (0.5, 0.99)])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_no_values(spark):
    from tabready.operators.quantiles import aggregate_with_quantiles

    df = spark.createDataFrame([(1, None), (2, None)], "g int, v double")
    assert exact_quantiles(df, "v", [0.5]).count() == 0
    row = aggregate_with_quantiles(df, F.col("v"), [F.count(F.lit(1)).alias("rows")], [0.5], ["med"]).first()
    assert row["rows"] == 2 and row["med"] is None
    grouped = aggregate_with_quantiles(df, F.col("v"), [F.count(F.lit(1)).alias("rows")], [0.5], ["med"], ["g"])
    assert sorted((r.g, r.rows, r.med) for r in grouped.collect()) == [(1, 1, None), (2, 1, None)]


EXTREMES = [float("inf"), float("-inf"), 1.7e308, -1.7e308, 1.7976931348623157e308, 0.0, -0.0, 5e-324, -5e-324, 2.2e-308, 1.0,
            1.0000000000000002, -1.0] + [10.0 ** k for k in range(-300, 301, 7)] + [-(10.0 ** k) for k in range(-300, 301, 13)]


@pytest.mark.parametrize("by", [["g"], []])
def test_any_double_ends(spark, by):
    values = sorted(EXTREMES * 3)
    df = spark.createDataFrame([("a", v) for v in values] + [(None, v) for v in values[::2]] + [("a", None), ("a", float("nan"))],
                               "g string, v double")
    ps = [0.0, 0.25, 0.5, 0.99, 1.0]
    got = exact_quantiles(df, "v", ps, by, buckets=16, final_rows=2)
    want = (df.where("NOT isnan(v)").groupBy(*by)).agg(*[F.percentile("v", p).alias(f"q_{p}") for p in ps])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_hot_group_is_not_hashed_on_its_key(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")).alias("g"),
                                   F.sqrt(F.col("id").cast("double")).alias("v"))
    got = exact_quantiles(df, "v", [0.5], ["g"], final_rows=500, names=["m"])
    assert {r.g: r.m for r in got.collect()}["hot"] == df.where("g = 'hot'").agg(F.percentile("v", 0.5)).first()[0]


def test_nan_is_missing_in_aggregates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),)], "v double")
    assert exact_quantiles(df, "v", [0.5], names=["m"]).first()["m"] == 2.0
