"""SURVEY 5(c)/(d) invariants: exact-size splits that do not depend on the
partitioning, audit + valid rows partition the input, permutation importance
sees only the features a model uses, a forest beats the mean baseline."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabready.operators import split
from tabready.operators import train as TR
from tabready.operators.importance import permutation_importance
from tabready.operators.metrics import regression_metrics
from tabready.operators.target import audit_target_outliers, filter_valid_target

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(n=st.integers(1, 300), seed=st.integers(0, 1000), parts=st.integers(1, 9), digits=st.integers(1, 3))
def test_split_exact_and_partition_independent(spark, n, seed, parts, digits):
    df = spark.range(n).select(F.col("id").cast("string").alias("k"))
    a = {r.k: r.data_split for r in split.deterministic_split(df, "k", seed=seed, hex_digits=digits).collect()}
    b = {r.k: r.data_split for r in
         split.deterministic_split(df.repartition(parts), "k", seed=seed, hex_digits=digits).collect()}
    assert a == b and len(a) == n
    sizes = split.split_sizes(n, (0.64, 0.16, 0.20))
    got = tuple(sum(1 for v in a.values() if v == lab) for lab in ("train", "validation", "test"))
    assert got == sizes


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.floats(-10, 3000, allow_nan=False)), min_size=1, max_size=60))
def test_audit_and_valid_partition_the_input(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t double")
    bad = {r.i for r in audit_target_outliers(df, "t", 8.0, 2500.0).collect()}
    good = {r.i for r in filter_valid_target(df, "t", 8.0, 2500.0).collect()}
    assert bad.isdisjoint(good) and bad | good == set(range(len(values)))


def test_permutation_importance_sees_only_used_features(spark):
    rows = [(str(i), float(i % 17), float((i * 7) % 5), 2.0 * (i % 17)) for i in range(200)]
    sample = spark.createDataFrame(rows, "id string, x double, z double, y double")
    scorer = lambda df: df.withColumn("predicted", 2.0 * F.col("x"))
    imp = {r.feature: r for r in permutation_importance(sample, scorer, ["x", "z"], "y", "id").collect()}
    assert imp["x"].importance_mean > 1.0 and imp["x"].repeats == 3
    assert imp["z"].importance_mean == 0.0 and imp["z"].importance_std == 0.0


def test_forest_beats_mean_baseline(spark):
    rows = [(str(i), float(i % 50), ["a", "b"][i % 2], 3.0 * (i % 50) + 10.0 * (i % 2) + (i % 7) * 0.1)
            for i in range(400)]
    df = split.deterministic_split(spark.createDataFrame(rows, "id string, x double, c string, y double"), "id")
    tr = df.filter(F.col("data_split") == "train")
    model = TR.Pipeline(stages=[*TR.feature_pipeline(["x"], ["c"]),
                                TR.random_forest(num_trees=20, max_depth=6, label="y")]).fit(tr)
    mean = tr.agg(F.avg("y")).first()[0]
    preds = model.transform(df).select("data_split", F.col("id").alias("row_id"), F.col("y").alias("actual"),
                                       F.col("prediction").alias("predicted"))
    both = preds.withColumn("model", F.lit("forest")).unionByName(
        preds.withColumn("predicted", F.lit(mean)).withColumn("model", F.lit("mean")))
    m = {r.model: r.rmse for r in regression_metrics(both).filter(F.col("data_split") == "test").collect()}
    assert m["forest"] < 0.5 * m["mean"] and math.isfinite(m["mean"])
