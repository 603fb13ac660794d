"""Imputation fitted on train and the budgeted candidate search."""

from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from tabready.operators import train as TR


def frame(spark):
    rows = [(float(i), ["a", "b", "c"][i % 3], 3.0 * i + (i % 3)) for i in range(60)]
    return spark.createDataFrame(rows, "x double, cat string, y double")


def estimators():
    return {
        "LinearRegression": LinearRegression(featuresCol="features", labelCol="y"),
        "DecisionTree": DecisionTreeRegressor(featuresCol="features", labelCol="y", maxDepth=3, seed=42),
    }


def test_search_respects_count_and_exclusions(spark):
    df = frame(spark)
    fitted = TR.candidate_search(df, ["x"], ["cat"], "y", estimators())
    assert [f.name for f in fitted] == ["LinearRegression", "DecisionTree"]
    assert all(f.fit_seconds > 0 for f in fitted)
    assert [f.name for f in TR.candidate_search(df, ["x"], ["cat"], "y", estimators(), max_models=1)] == \
        ["LinearRegression"]
    assert [f.name for f in TR.candidate_search(df, ["x"], ["cat"], "y", estimators(),
                                                excluded=["LinearRegression"])] == ["DecisionTree"]


def test_search_deadline_drops_overrunning_fits(spark):
    df = frame(spark)
    assert TR.candidate_search(df, ["x"], ["cat"], "y", estimators(), time_limit_seconds=0.05) == []
    # the session is usable after the job group was cancelled
    assert df.agg(F.count(F.lit(1))).first()[0] == 60


def test_imputers_fit_on_train_only(spark):
    df = spark.createDataFrame([("train", 1.0, "a"), ("train", 3.0, "b"), ("train", None, "b"),
                                ("test", 100.0, "z"), ("test", None, None)], "s string, v double, c string")
    tr = df.filter(F.col("s") == "train")
    assert TR.fit_median_imputer(tr, ["v"]) == {"v": 2.0}
    assert TR.fit_mode_imputer(tr, ["c"]) == {"c": "b"}
    filled = TR.apply_imputer(df, {"v": 2.0, "c": "b"}).filter(F.col("s") == "test").orderBy("v").collect()
    assert [(r.v, r.c) for r in filled] == [(2.0, "b"), (100.0, "z")]


def test_forest_in_parts_fits_all_trees(spark, monkeypatch):
    rows = [(i, float(i % 50), ["a", "b", None][i % 3], 3.0 * (i % 50) + (i % 7) * 0.1, "train" if i % 4 else "test") for i in range(600)]
    df = spark.createDataFrame(rows, "id long, x double, c string, y double, s string")
    forest = TR.random_forest(num_trees=12, max_depth=6, label="y")
    fits, real = [], TR.RandomForestRegressor.fit

    def fit(self, data):
        model = real(self, data)
        fits.append((self.getNumTrees(), self.getSeed(), model.totalNumNodes))
        return model

    monkeypatch.setattr(TR.RandomForestRegressor, "fit", fit)
    for nodes in (200, 100_000):
        fits.clear()
        got = TR.forest_predictions(df.where("s = 'train'"), df, ["x"], ["c"], forest, nodes).collect()
        assert sum(n for n, _, _ in fits) == 12 and len({seed for _, seed, _ in fits}) == len(fits)
        assert (len(fits) == 1) == (nodes == 100_000)
        assert nodes > 200 or max(k for _, _, k in fits) <= 400  # no part holds the whole forest
        assert sorted(r.id for r in got) == list(range(600))
        assert sum(abs(r.prediction - r.y) for r in got) / 600 < 12
