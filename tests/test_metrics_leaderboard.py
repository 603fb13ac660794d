"""A12, W2-W10, P16 with the reference's leaderboards and importances."""

import pytest
from pyspark.sql import functions as F

from tabready.operators import leaderboard as L
from tabready.operators.metrics import actual_vs_predicted_grid, regression_metrics


def test_regression_metrics(spark):
    df = spark.createDataFrame([("m", "s", 1.0, 1.0), ("m", "s", 2.0, 2.0), ("m", "s", 3.0, 4.0)],
                               "model string, data_split string, actual double, predicted double")
    r = regression_metrics(df).first()
    assert (r.rmse, r.mae, r.r2) == (0.57735, 0.333333, 0.5)


def test_constant_target_r2(spark):
    perfect = spark.createDataFrame([("m", "s", 2.0, 2.0)] * 3, "model string, data_split string, actual double, predicted double")
    off = spark.createDataFrame([("m", "s", 2.0, 3.0)] * 3, "model string, data_split string, actual double, predicted double")
    assert regression_metrics(perfect).first().r2 == 1.0
    assert regression_metrics(off).first().r2 == 0.0


def test_missing_prediction_raises(spark):
    df = spark.createDataFrame([("m", "s", 1.0, None)], "model string, data_split string, actual double, predicted double")
    with pytest.raises(Exception, match="lacks its actual"):
        regression_metrics(df).collect()


def leaderboard_a(spark):
    return spark.createDataFrame([("A", -160.0, -165.0, 8.0), ("B", -170.0, -175.0, 4.0), ("C", -180.0, -185.0, 2.0)],
                                 "model string, score_val double, score_test double, fit_time_marginal double")


def test_score_leaderboard(spark):
    lb = L.rank_leaderboard(L.normalize_score_leaderboard(leaderboard_a(spark)))
    best = lb.filter(F.col("validation_rank") == 1).first()
    assert (best.model, best.validation_rmse) == ("A", 160.0)
    top = L.top_models_by_score(lb, 2).orderBy("score_rank")
    assert [r.model for r in top.collect()] == ["A", "B"]
    assert L.select_speed_column(lb.columns) == "fit_time_marginal"
    fast = L.top_models_by_training_speed(lb, 2).orderBy("speed_rank")
    assert [r.model for r in fast.collect()] == ["C", "B"]


def leaderboard_b(spark):
    rows = [("GBM_1", 170.0, 130.0, 4000, 0.03), ("GLM_1", 160.0, 120.0, 1000, 0.01), ("DRF_1", 180.0, 140.0, 2000, 0.02)]
    return spark.createDataFrame(rows, "model_id string, rmse double, mae double, training_time_ms bigint, "
                                       "predict_time_per_row_ms double")


def test_h2o_style_leaderboard(spark):
    lb = L.rank_leaderboard(leaderboard_b(spark), score="rmse", name="model_id")
    assert lb.filter(F.col("validation_rank") == 1).first().model_id == "GLM_1"
    score = L.top_models_by_score(lb, 2, score="rmse", name="model_id").orderBy("score_rank")
    assert [r.model_id for r in score.collect()] == ["GLM_1", "GBM_1"]
    speed = L.top_models_by_training_speed(lb, 2, time_col="training_time_ms", score="rmse", name="model_id")
    assert [r.model_id for r in speed.orderBy("speed_rank").collect()] == ["GLM_1", "DRF_1"]
    pred = L.top_models_by_prediction_speed(lb, 2, score="rmse", name="model_id")
    assert [r.model_id for r in pred.orderBy("prediction_speed_rank").collect()] == ["GLM_1", "DRF_1"]


def test_no_numeric_rmse_raises(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None)], "model string, validation_rmse string")
    with pytest.raises(Exception, match="as its score"):
        L.rank_leaderboard(df).collect()


def test_null_timing_dropped(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 2.0, 5.0)], "model string, validation_rmse double, fit_time double")
    assert [r.model for r in L.top_models_by_training_speed(df, 3).collect()] == ["b"]


def test_rank_and_scale_importance(spark):
    imp = spark.createDataFrame([("age", 1.0), ("weight", 3.0), ("bmi", 2.0), ("x", None)],
                                "variable string, relative_importance double")
    ranked = L.rank_importance(imp).orderBy("importance_rank")
    assert [r.variable for r in ranked.collect()] == ["weight", "bmi", "age"]
    scaled = {r.variable: (r.scaled_importance, r.percentage) for r in L.scaled_importance(ranked).collect()}
    assert scaled["weight"] == (1.0, 0.5) and scaled["age"] == (pytest.approx(1 / 3), pytest.approx(1 / 6))


def test_top_features(spark):
    ranked = spark.createDataFrame([(3, "height"), (1, "weight"), (2, "age"), (4, "gender"), (5, " weight ")],
                                   "importance_rank int, feature string")
    assert L.top_features(ranked, 3).first().top_features == ["weight", "age", "height"]
    dupes = spark.createDataFrame([(1, "weight"), (2, "weight ")], "importance_rank int, feature string")
    with pytest.raises(Exception, match="3 top features are asked for, found 1"):
        L.top_features(dupes, 3).collect()


def test_grid_counts_every_point(spark):
    df = spark.createDataFrame([("m", float(i), float(i) + 0.5) for i in range(50)], "model string, actual double, predicted double")
    grid = actual_vs_predicted_grid(df, bins=10)
    assert grid.agg(F.sum("points")).first()[0] == 50
    assert grid.agg(F.max("actual_bin"), F.max("predicted_bin")).first() == (9, 9)
