"""A1, A8-A11, F12, F14, F8, Q1-Q3, S1, S4-S12, P1, P3, F7, F15."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tabready import contract
from tabready.operators import gates, profile
from tabready.operators.features import synthesize_identifier
from tabready.sources import io


def insights_frame(spark):
    rows = [(30.0, 200.0, "male", 300.0, "train"), (40.0, None, "female", 350.0, "train"),
            (50.0, 180.0, "male", 400.0, "train"), (35.0, 190.0, "male", 320.0, "test")]
    return spark.createDataFrame(rows, "age double, height double, gender string, total double, data_split string")


def test_data_insights(spark):
    out = {(r.section, r.name): r.value for r in profile.data_insights(
        insights_frame(spark), ["age", "height", "gender"], ["age", "height"], ["gender"], "total").collect()}
    assert out[("missing_percentage_train", "height")] == pytest.approx(33.333333, abs=1e-6)
    assert out[("categorical_cardinality_train", "gender")] == 2.0
    assert out[("row_counts", "train")] == 3.0 and out[("row_counts", "test")] == 1.0
    assert out[("absolute_numeric_correlation_with_target", "age")] == pytest.approx(1.0)


def test_column_profile_and_draft_contract(spark):
    rows = [(str(i), float(i % 3), "x", f"cat{i}", None if i % 2 else "1,5") for i in range(300)]
    df = spark.createDataFrame(rows, "member_id string, age double, const string, tag string, text_num string")
    prof = {r.column: r for r in profile.column_profile(df, identifiers=["member_id"]).collect()}
    assert prof["age"].unique_count == 3 and prof["age"].numeric_parse_rate == 1.0
    assert prof["age"].sample_values == "0.0 | 1.0 | 2.0"
    assert prof["const"].is_constant
    assert prof["tag"].is_high_cardinality and prof["tag"].unique_ratio == 1.0
    assert prof["text_num"].missing_percentage == 50.0 and prof["text_num"].numeric_parse_rate == 0.0
    draft = {r.column: r.recommended_action for r in profile.draft_feature_contract(
        profile.column_profile(df, identifiers=["member_id"])).collect()}
    assert draft == {"member_id": "exclude", "age": "candidate", "const": "exclude", "tag": "review",
                     "text_num": "exclude"}


def test_sparse_features(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (4.0, 1.0)], "a double, b double")
    kept, dropped = profile.drop_sparse_features(df, ["a", "b"], 0.70)
    assert dropped == ["b"] and kept.columns == ["a"]


def test_normalize_columns_and_contract_helpers(spark):
    df = spark.createDataFrame([(1, 2)], "` Body Weight (lb) ` int, `Age` int")
    assert contract.normalize_columns(df).columns == ["body_weight_lb", "age"]
    with pytest.raises(ValueError, match="Duplicate columns"):
        contract.normalize_columns(spark.createDataFrame([(1, 2)], "`A b` int, `a_B` int"))
    assert contract.resolve_identifier(["x", "member_id"], ["id", "member_id"]) == "member_id"
    with pytest.raises(ValueError, match="leak"):
        contract.reject_prohibited_features(["age", "total"], ["total", "part_a"])
    with pytest.raises(ValueError, match="no model features"):
        contract.reject_prohibited_features([], ["total"])
    c = contract.Contract(identifier="member_id", target="total",
                          components=("part_a", "part_b", "part_c", "part_d"),
                          numeric_features=("age", "weight"), categorical_features=("gender",),
                          engineered={"bmi": F.lit(1.0)})
    fc = {r.column: (r.role, r.action) for r in contract.final_feature_contract(
        spark, c, ["member_id", "age", "weight", "gender", "part_a", "part_b", "part_c", "part_d"]).collect()}
    assert all(fc[x] == ("target_component", "exclude") for x in ("part_a", "part_b", "part_c", "part_d"))
    assert fc["bmi"] == ("numeric_feature", "include")


def test_validate_modeling_table(spark):
    df = spark.createDataFrame([(1, 2.0, 30.0), (None, None, 20.0)], "id int, y double, age double")
    checks = {r.check_name: r.violations for r in gates.validate_modeling_table(df, "id", "y", ["age"]).collect()}
    assert checks == {"non_empty": 0, "target_present": 1, "identifier_present": 1}
    with pytest.raises(ValueError, match="leak"):
        gates.validate_modeling_table(df, "id", "y", ["age", "y"])


def test_gate_status(spark):
    ok = spark.createDataFrame([("a", 1)], "x string, n int")
    checks = gates.expectation_table([gates.row_count_check(ok, "t", 1), gates.row_count_check(ok, "t", 5)])
    assert gates.gate_status(checks).first().gate_status == "FAIL"
    warn = spark.createDataFrame([("PASS",), ("WARN",)], "status string")
    assert gates.gate_status(gates.status_check(warn, "w", warn_values=["WARN"])).first().gate_status == \
        "PASS_WITH_WARNINGS"


def test_fingerprint_is_order_insensitive(spark):
    df = spark.range(1000).withColumn("s", F.col("id").cast("string"))
    a = io.dataset_fingerprint(df).first()
    b = io.dataset_fingerprint(df.orderBy(F.desc("id")).repartition(7)).first()
    c = io.dataset_fingerprint(df.filter(F.col("id") != 3)).first()
    assert a == b and a != c and a.row_count == 1000


def test_synthesize_identifier_unique_and_stable(spark):
    df = spark.createDataFrame([("a", 1)] * 5 + [("b", 2)], "x string, y int")
    ids = [r.row_id for r in synthesize_identifier(df).collect()]
    assert len(set(ids)) == 6
    again = {r.row_id for r in synthesize_identifier(df.repartition(3)).collect()}
    assert again == set(ids)


def test_csv_and_run_registry_sources(spark):
    base = tempfile.mkdtemp(prefix="tabready-io-")
    df = spark.createDataFrame([("1", "4:30"), ("2", "1,200")], "id string, v string")
    paths = io.write_table(df, base, "t", ["csv", "parquet"])
    back = io.read_csv_table(spark, paths["csv"])
    assert dict(back.dtypes) == {"id": "string", "v": "string"} and back.count() == 2
    with pytest.raises(ValueError, match="Duplicate columns"):
        io.require_columns(["a", "A"])
    doc = os.path.join(base, "runs")
    os.makedirs(doc)
    for i in range(3):
        with open(os.path.join(doc, f"r{i}.json"), "w") as fh:
            json.dump({"platform": f"p{i}", "validation_rmse": 1.0 + i, "model_features": ["a"],
                       "package_versions": {"spark": "4"}}, fh, indent=2)
    runs = io.read_run_registry(spark, os.path.join(doc, "*.json"))
    assert runs.count() == 3 and runs.filter(F.col("validation_rmse") == 2.0).first().platform == "p1"
    path = io.write_splits(spark.createDataFrame([(1, "train"), (2, "test")], "id int, data_split string"), base, "s")
    assert spark.read.parquet(path).filter(F.col("data_split") == "test").count() == 1


def test_catalog_report_prediction_and_model_sinks(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    base = tempfile.mkdtemp(prefix="tabready-sinks-")
    lb = spark.createDataFrame([("m1", 2.0), ("m2", 1.0)], "model string, validation_rmse double")
    # S7 + S3: saved tables replace earlier versions and read back by name
    io.save_results_as_tables({"tabready_lb": lb.limit(1)})
    assert io.save_results_as_tables({"tabready_lb": lb}) == ["tabready_lb"]
    assert sorted(r.model for r in io.read_catalog_table(spark, "tabready_lb").collect()) == ["m1", "m2"]
    # One file per report table
    path = io.write_report_table(lb, base, "leaderboard", "json")
    assert len([f for f in os.listdir(path) if f.endswith(".json")]) == 1
    assert spark.read.json(path).count() == 2
    # Residual added, one directory per model
    preds = spark.createDataFrame([("m1", "test", 1, 3.0, 2.5), ("m2", "test", 1, 3.0, 3.5)],
                                  "model string, data_split string, id int, actual double, predicted double")
    back = spark.read.parquet(io.save_predictions(preds, base))
    assert {(r.model, r.residual) for r in back.collect()} == {("m1", 0.5), ("m2", -0.5)}
    # A fitted pipeline survives save and load
    train = spark.createDataFrame([(float(x), 2.0 * x + 1.0) for x in range(10)], "x double, y double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                             LinearRegression(featuresCol="features", labelCol="y")]).fit(train)
    loaded = io.load_model(io.save_model(model, base, "lr"))
    got = [round(r.prediction, 6) for r in loaded.transform(train).orderBy("x").collect()]
    assert got == [round(r.prediction, 6) for r in model.transform(train).orderBy("x").collect()]
