"""NaN counts as missing in every summary; guards hold whatever columns are
selected; exact splits refuse identifiers that repeat at a cut."""

import pytest
from pyspark.sql import functions as F

from tabready.operators import compare, features, gates, importance, metrics, profile, split, target, train

NAN = float("nan")


@pytest.fixture
def cells(spark):
    return spark.createDataFrame(
        [(1, 1.0, 2.0, "train"), (2, 2.0, NAN, "train"), (3, 3.0, None, "train"), (4, NAN, 8.0, "train"), (5, None, -0.0, "train"), (6, 4.0, 0.0, "train")],
        "id int, y double, x double, data_split string")


def test_statistics(cells):
    row = target.target_statistics(cells, "y").first()
    assert (row.target_count, row.target_min, row.target_max, row.target_mean, row.target_median) == (4, 1.0, 4.0, 2.5, 2.5)
    s = split.split_summary(cells, "y").first()
    assert (s.rows, s.target_max, s.target_mean, s.target_median) == (6, 4.0, 2.5, 2.5)


def test_missing_and_sparse(cells):
    assert {r.feature: r.missing_percentage for r in profile.missing_percentage(cells, ["id", "x"]).collect()} == {"id": 0.0, "x": 33.333333}
    kept, dropped = profile.drop_sparse_features(cells, ["x", "y"], 0.2)
    assert dropped == ["x", "y"] and kept.columns == ["id", "data_split"]


def test_profile(cells):
    r = {x.column: x for x in profile.column_profile(cells).collect()}
    assert (r["x"].non_null_count, r["x"].missing_count, r["x"].unique_count) == (4, 2, 3)  # -0.0 is 0.0


def test_correlation_and_insights(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i if i else NAN, "train") for i in range(6)], "y double, x double, data_split string")
    assert profile.target_correlation(df, ["x"], "y").first().abs_correlation == 1.0
    rows = {(r.section, r.name): r.value for r in profile.data_insights(df, ["x"], ["x"], [], "y").collect()}
    assert rows["missing_percentage_train", "x"] == 16.666667


def test_audit_and_gates(cells):
    audit = {r.id: r.target_quality_reason for r in target.audit_target_outliers(cells, "y", 1.5, 3.5).collect()}
    assert audit == {1: "below_minimum", 4: "missing_target", 5: "missing_target", 6: "above_maximum"}
    assert [r.id for r in target.filter_valid_target(cells, "y", 1.5, 3.5).orderBy("id").collect()] == [2, 3]
    checks = {r.check_name: r.violations for r in gates.validate_modeling_table(cells, "id", "y", ["x"]).collect()}
    assert checks["target_present"] == 2
    checks = {r.check_name: r.violations for r in gates.validate_split_export(cells, "id", "y").collect()}
    assert checks["target_present"] == 2


def test_imputer(cells):
    fill = train.fit_median_imputer(cells, ["y"])
    assert fill == {"y": 2.5}
    assert sorted(r.y for r in train.apply_imputer(cells, fill).collect()) == [1.0, 2.0, 2.5, 2.5, 3.0, 4.0]


def test_names_are_not_sql(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], ["it's", "a b`c"])
    df = df.withColumnRenamed("a b`c", "a b")
    got = {r.feature: r.missing_percentage for r in profile.missing_percentage(df, ["it's", "a b"]).collect()}
    assert got == {"it's": 50.0, "a b": 0.0}


def test_repeated_identifiers_at_a_cut(spark):
    df = spark.range(1000).select((F.col("id") % 5).alias("id"))
    with pytest.raises(ValueError, match="repeats at a cut"):
        split.deterministic_split(df, "id")
    with pytest.raises(ValueError, match="repeats at a cut"):
        split.sample_rows(df, "id", 50)


def test_metric_guard_on_any_column(spark):
    preds = spark.createDataFrame([("m", "test", 1.0, 2.0), ("m", "test", None, 1.0)], "model string, data_split string, actual double, predicted double")
    for column in ("mae", "rmse", "r2", "rows"):
        with pytest.raises(Exception, match="lacks its actual"):
            metrics.regression_metrics(preds).select(column).collect()


def runs(spark, baselines):
    rows = [("e", "p", "all_features", 3, "A", 1.0, 1.0, 1.0, 0.5, 1.0, 1.0, True)]
    rows += [("e", "b", "all_features", 3, "RandomForestRegressor", 2.0, 2.0, 2.0, 0.4, 1.0, 1.0, False)] * baselines
    return spark.createDataFrame(rows, "experiment_id string, platform string, feature_set string, feature_count int, best_model string, validation_rmse double, "
                                       "test_rmse double, test_mae double, test_r2 double, training_seconds double, prediction_seconds double, is_automl boolean")


def test_baseline_guard_on_any_column(spark):
    assert compare.compare_to_baseline(runs(spark, 1)).count() == 2
    for n in (0, 2):
        for column in ("platform", "test_rmse_change_vs_baseline_percent"):
            with pytest.raises(Exception, match="needs one"):
                compare.compare_to_baseline(runs(spark, n)).select(column).collect()


def test_empty_models_raise(spark):
    automl = spark.createDataFrame([], "experiment_id string, platform string, feature_set string, feature_count int, best_model string, validation_rmse double, "
                                       "test_rmse double, test_mae double, test_r2 double, training_wall_clock_seconds double, prediction_seconds double, model_features array<string>")
    for models in ("CAST(array() AS array<struct<model_name: string>>)", "CAST(NULL AS array<struct<model_name: string>>)"):
        base = spark.sql("SELECT 'e' AS experiment_id, transform(" + models + ", m -> named_struct('model_name', m.model_name, 'feature_set', 'all_features', "
                         "'platform', 'b', 'feature_count', 1, 'validation_rmse', 1D, 'test_rmse', 1D, 'test_mae', 1D, 'test_r2', 1D, 'training_wall_clock_seconds', 1D, "
                         "'prediction_seconds', 1D, 'model_features', array('x'))) AS models")
        with pytest.raises(Exception, match="lists no models"):
            compare.normalize_run_rows(automl, base).collect()


def test_identifiers_of_equal_rows(spark):
    df = spark.createDataFrame([("a", None)] * 5 + [("b", 1)], "s string, n int").repartition(4)
    ids = [r.row_id for r in features.synthesize_identifier(df).collect()]
    assert len(ids) == len(set(ids)) == 6
    part = [r.row_id for r in features.synthesize_identifier(df.withColumn("k", F.monotonically_increasing_id()), columns=["s"]).collect()]
    assert len(set(part)) == 6


def test_importance_of_the_whole_split(spark):
    df = spark.range(500).select("id", F.col("id").cast("double").alias("y"), F.col("id").cast("double").alias("x"), F.lit(1.0).alias("z"))
    scorer = lambda d: d.withColumn("predicted", F.col("x"))
    whole = {r.feature: r.importance_mean for r in importance.permutation_importance(df, scorer, ["x", "z"], "y", "id").collect()}
    assert whole["z"] == 0 and whole["x"] > 100
    old = importance.BUCKET_ROWS
    importance.BUCKET_ROWS = 10
    try:
        again = {r.feature: r.importance_mean for r in importance.permutation_importance(df, scorer, ["x", "z"], "y", "id").collect()}
    finally:
        importance.BUCKET_ROWS = old
    assert again == whole
