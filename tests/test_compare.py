"""L16, W3, J2-J4, U3, L15 with the reference's comparison fixture."""

import pytest
from pyspark.sql import functions as F

from tabready.operators import compare

SCHEMA = ("experiment_id string, platform string, feature_set string, feature_count int, best_model string, "
          "validation_rmse double, test_rmse double, test_mae double, test_r2 double, training_seconds double, "
          "prediction_seconds double, is_automl boolean, model_features array<string>")


def runs(spark):
    rows = [
        ("e", "scikit-learn", "all_features", 13, "RandomForestRegressor", 170.0, 175.0, 130.0, 0.60, 30.0, 1.0, False, ["a"]),
        ("e", "AutoGluon", "all_features", 13, "WeightedEnsemble", 155.0, 160.0, 120.0, 0.70, 900.0, 2.0, True, ["a", "b"]),
        ("e", "AutoGluon", "top_features", 3, "GBM", 157.0, 162.0, 122.0, 0.68, 400.0, 0.5, True, ["b"]),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_rank_and_baseline(spark):
    ranked = compare.compare_to_baseline(compare.rank_runs(runs(spark)))
    best = ranked.filter(F.col("validation_rank") == 1).first()
    assert best.platform == "AutoGluon" and best.feature_set == "all_features"
    assert best.test_rmse_change_vs_baseline_percent < 0
    assert {r.training_speed_rank for r in ranked.collect()} == {1, 2, 3}


def test_ranks_share_ties(spark):
    df = runs(spark).withColumn("validation_rmse", F.lit(1.0))
    assert {r.validation_rank for r in compare.rank_runs(df).collect()} == {1}


def test_baseline_must_be_unique(spark):
    with pytest.raises(Exception, match="needs one"):
        compare.compare_to_baseline(runs(spark).unionByName(runs(spark))).collect()


def test_recommendation(spark):
    rec = compare.build_recommendation(runs(spark), 2.0).first()
    assert rec.best_feature_set == "all_features" and rec.best_best_model == "WeightedEnsemble"
    assert rec.fastest_feature_set == "top_features"
    assert rec.reduced_feature_count == 3
    assert rec.reduced_validation_degradation_percent == pytest.approx(2 / 155 * 100)
    strict = compare.build_recommendation(runs(spark), 1.0).first()
    assert strict.reduced_platform is None


def test_recommendation_needs_automl(spark):
    with pytest.raises(Exception, match="no experiment run"):
        compare.build_recommendation(runs(spark).filter(~F.col("is_automl"))).collect()


def test_compare_feature_sets(spark):
    rows = [
        ("e", "p", "all_features", 13, "ModelA", 160.0, 165.0, 125.0, 0.65, 900.0, 1.0, True, ["age", "weight"]),
        ("e", "p", "top_features", 3, "ModelB", 162.0, 167.0, 127.0, 0.63, 500.0, 0.5, True, ["weight", "bmi", "age"]),
    ]
    r = compare.compare_feature_sets(spark.createDataFrame(rows, SCHEMA)).first()
    assert r.validation_rmse_delta_top_minus_all == 2.0
    assert r.training_seconds_delta_top_minus_all == -400.0
    assert r.validation_performance_assessment == "degraded"
    assert (r.all_features_count, r.top_features_count) == (13, 3)


def test_feature_overlap(spark):
    pairs = spark.createDataFrame([(["weight", "age", "bmi"], ["weight", "bmi", "region"]), ([], [])],
                                  "first_features array<string>, second_features array<string>")
    rows = compare.feature_overlap(pairs).collect()
    assert rows[0].shared_features == ["bmi", "weight"] and rows[0].jaccard_similarity == 0.5
    assert rows[1].shared_feature_count == 0 and rows[1].jaccard_similarity == 0.0


def test_normalize_run_rows(spark):
    automl = spark.createDataFrame(
        [("e", "p", "all_features", 2, "M", 1.0, 2.0, 3.0, 0.5, 10.0, 1.0, ["a", "b"])],
        "experiment_id string, platform string, feature_set string, feature_count int, best_model string, "
        "validation_rmse double, test_rmse double, test_mae double, test_r2 double, "
        "training_wall_clock_seconds double, prediction_seconds double, model_features array<string>")
    base = spark.createDataFrame(
        [("e", [("all_features", 2, "MeanPredictor", 5.0, 5.0, 4.0, 0.0, 0.1, 0.01, ["a"])])],
        "experiment_id string, models array<struct<feature_set string, feature_count int, model_name string, "
        "validation_rmse double, test_rmse double, test_mae double, test_r2 double, "
        "training_wall_clock_seconds double, prediction_seconds double, model_features array<string>>>")
    out = compare.normalize_run_rows(automl, base).collect()
    assert sorted((r.platform, r.is_automl) for r in out) == [("p", True), ("scikit-learn", False)]
    with pytest.raises(ValueError, match="lack the fields"):
        compare.normalize_run_rows(automl.drop("test_r2"))
