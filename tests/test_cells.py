"""L6 on cells: trees equal Spark's, and a forest's work does not grow with its depth."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from tabready.operators import cells as C
from tabready.operators import train as TR

SF_SMALL = "/root/testdata/sf0.001"


def frame(spark, n=1500):
    rows = [(i, float((i * i) % 97), float(i % 7) if i % 20 else float("nan"), ["a", "b", "c", None][(i // 3) % 4], float((i * 31) % 211 + 40 * ((i // 3) % 4)),
             "train" if i % 4 else "test") for i in range(n)]
    return spark.createDataFrame(rows, "id long, x double, z double, c string, y double, s string").repartition(5, "id")


def test_tree_equals_sparks_tree(spark):
    df = frame(spark)
    rows = TR.Pipeline(stages=TR.feature_pipeline(["x"], ["c"])).fit(df).transform(df)
    cuts = C.bin_thresholds(rows, "features", 32)
    spark_tree = DecisionTreeRegressor(featuresCol="features", labelCol="y", maxDepth=12, minInstancesPerNode=2).fit(rows)
    table = spark_tree.transform(rows).select(vector_to_array("features").alias("x"), "y", "prediction").toArrow()
    y = table["y"].to_numpy()
    keys, at = C._distinct(C._pack(C._matrix(table["x"]), cuts))
    tree = C.grow(keys, np.bincount(at).astype(float), np.bincount(at, y), cuts, 12, 2, 0.0, len(cuts), np.random.default_rng(0))
    assert np.allclose(C._predicted(C._unpack(keys, cuts), [tree])[at], table["prediction"].to_numpy())


def test_bins_round_trip_and_nan_is_last():
    cuts = [np.array([0.5, 1.5]), np.array([0.5]), np.array([]), *[np.array([0.5])] * 9]
    x = np.random.default_rng(1).integers(0, 3, (50, 12)).astype(float)
    x[::7, 0] = np.nan
    codes = C._unpack(C._pack(x, cuts), cuts)
    assert set(codes[::7, 0]) == {2} and (codes[:, 2] == 0).all()
    assert (codes[:, 1] == (x[:, 1] > 0.5)).all() and (codes[:, 11] == (x[:, 11] > 0.5)).all()


def jobs(spark, group, run):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        run()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_of_a_forest_do_not_grow_with_depth(spark):
    df = frame(spark)
    made = {}
    for depth in (3, 14):
        forest = TR.random_forest(num_trees=10, max_depth=depth, label="y")
        made[depth] = jobs(spark, f"forest-{depth}", lambda f=forest: TR.forest_predictions(
            df.where("s = 'train'"), df, ["x", "z"], ["c"], f).count())
    assert made[14] <= made[3] + 5


@pytest.mark.parametrize("setting", ["merged", "by rows"])
def test_other_ways_to_fit_agree(spark, monkeypatch, setting):
    df = frame(spark)
    forest = TR.random_forest(num_trees=10, max_depth=8, label="y")

    def fitted():
        out = TR.forest_predictions(df.where("s = 'train'"), df, ["x", "z"], ["c"], forest)
        return {r.id: r.prediction for r in out.select("id", "prediction").collect()}, out.columns

    plain, columns = fitted()
    if setting == "merged":  # in several rounds, as with many partitions
        monkeypatch.setattr(C, "MERGED", 2)
    else:  # more cells than a task takes
        monkeypatch.setattr(C, "MOST_CELLS", 1)
    other, others = fitted()
    assert columns == others == [*df.columns, "prediction"] and plain.keys() == other.keys() == set(range(1500))
    apart = np.abs([plain[i] - other[i] for i in plain])
    assert np.mean(apart > 1e-6) < 0.01 if setting == "merged" else np.mean(apart) < 12


@pytest.mark.parametrize("column, value, says", [("y", None, "(?i)label"), ("y", float("nan"), "(?i)label"), ("x", float("nan"), "NaN or")])
def test_lost_training_values_are_rejected(spark, column, value, says):
    df = frame(spark, 60).withColumn(column, F.when(F.col("id") != 1, F.col(column)).otherwise(F.lit(value)))
    with pytest.raises(Exception, match=says):
        TR.forest_predictions(df.where("s = 'train'"), df, ["x"], ["c"], TR.random_forest(num_trees=2, max_depth=3, label="y"))


def test_forest_beats_mean_sends_no_rows_to_a_fit_by_levels(spark, monkeypatch):
    from tabready.plans.experiment_queries import q_forest_beats_mean

    def by_levels(self, dataset):
        raise AssertionError("Spark's fit aggregates every open node at every level")

    monkeypatch.setattr(TR.RandomForestRegressor, "_fit_java", by_levels)
    got = {r.data_split: r for r in q_forest_beats_mean(spark, SF_SMALL).collect()}
    assert {s: r.rows for s, r in got.items()} == {"train": 128, "validation": 32, "test": 40}
    assert all(r.forest_is_better for r in got.values())
