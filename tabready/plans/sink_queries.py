"""Registered queries that write and read back (S3-S11), and queries whose
input holds NaN, each with its SQL twin."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tabready.functions.cleaning import safe_float
from tabready.operators import profile, target, train
from tabready.operators.metrics import align_sample_target, regression_metrics
from tabready.operators.split import sample_rows, split_summary
from tabready.plans import model_sql as M
from tabready.plans import models as X
from tabready.plans import sql as S
from tabready.plans.standins import DOC_CATEGORICAL, DOC_NUMERIC, DOC_TARGET, SEED, doc_splits, table
from tabready.session import ensure_checkpoint_dir
from tabready.sources import io

ALL_DOC = [*DOC_NUMERIC, *DOC_CATEGORICAL]
COLUMNS = ", ".join(["doc_id", *ALL_DOC, DOC_TARGET, "data_split"])
SAMPLE_ROWS = 50
SPARSE_THRESHOLD = 0.50


def _folder(spark) -> str:
    return ensure_checkpoint_dir(spark).rstrip("/") + "/sinks"


def q_catalog_roundtrip(spark, sf):
    """S7 + S3: the split model table saved to the catalog and read by name."""
    name = f"doc_splits_{uuid.uuid4().hex}"
    io.save_results_as_tables({name: doc_splits(spark, sf)})
    return io.read_catalog_table(spark, name)


def q_split_export_roundtrip(spark, sf):
    """One folder per split; only the test folder is read back."""
    path = io.write_splits(doc_splits(spark, sf), _folder(spark), "doc_splits")
    return spark.read.parquet(path).filter(F.col("data_split") == "test")


def q_report_roundtrip(spark, sf):
    """The split summary as one JSON report file, read back."""
    path = io.write_report_table(split_summary(doc_splits(spark, sf), DOC_TARGET), _folder(spark), "split_summary")
    return spark.read.schema("data_split string, rows long, target_mean double, target_max double").json(path)


def q_predictions_roundtrip(spark, sf):
    """Test predictions with residuals, partitioned by model, read back."""
    preds = X.predictions(spark, sf).filter(F.col("data_split") == "test")
    path = io.save_predictions(preds, _folder(spark))
    return spark.read.parquet(path).select("model", "row_id", F.round("residual", 6).alias("residual"))


def _line_model(spark, sf):
    """Least squares of the target on the word count, fitted on the train split."""
    est = LinearRegression(labelCol=DOC_TARGET, solver="normal", regParam=0.0)
    fit = train.candidate_search(doc_splits(spark, sf).filter(F.col("data_split") == "train"), ["word_count"], [], DOC_TARGET,
                                 {"line": est})
    return fit[0].model


def q_model_roundtrip(spark, sf):
    """S11 with L4, L7 and L9: a fitted pipeline saved, loaded and scored on the test split."""
    path = io.save_model(_line_model(spark, sf), _folder(spark), "line")
    scored = io.load_model(path).transform(doc_splits(spark, sf).filter(F.col("data_split") == "test"))
    return scored.select("doc_id", F.round("prediction", 4).alias("predicted"))


_LINE = f"""fit AS (SELECT regr_slope({DOC_TARGET}, word_count) AS s, regr_intercept({DOC_TARGET}, word_count) AS i
  FROM doc_splits WHERE data_split = 'train')"""
SQL_MODEL = S.with_(S.DOC_SPLITS) + f""", {_LINE}
SELECT doc_id, round(i + s * word_count, 4) AS predicted FROM doc_splits, fit WHERE data_split = 'test'"""


def q_candidate_metrics(spark, sf):
    """L7 + L9 + A12: the fitted line's metrics on every split."""
    scored = _line_model(spark, sf).transform(doc_splits(spark, sf))
    preds = scored.select(F.lit("line").alias("model"), "data_split", F.col(DOC_TARGET).alias("actual"), F.col("prediction").alias("predicted"))
    return regression_metrics(preds, digits=4)


SQL_CANDIDATE = S.with_(S.DOC_SPLITS) + f""", {_LINE},
e AS (SELECT data_split, {DOC_TARGET} AS y, {DOC_TARGET} - (i + s * word_count) AS e FROM doc_splits, fit)
SELECT 'line' AS model, data_split, count(*) AS rows, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae,
  round(1 - sum(e * e) / (var_pop(y) * count(*)), 4) AS r2 FROM e GROUP BY data_split"""


def q_assemble(spark, sf):
    """L4: the assembled vector of the label-free numeric features, as an array."""
    stages = train.feature_pipeline(["word_count", "line_count"], [])
    out = Pipeline(stages=stages).fit(doc_splits(spark, sf)).transform(doc_splits(spark, sf))
    return out.select("doc_id", train.vector_to_array("features").alias("f")).select(
        "doc_id", F.col("f")[0].alias("slot_0"), F.col("f")[1].alias("slot_1"))


def q_drop_sparse(spark, sf):
    """the sparse label columns are gone from the table at 50 %."""
    kept, _ = profile.drop_sparse_features(doc_splits(spark, sf), ALL_DOC, SPARSE_THRESHOLD)
    return kept


def q_align_sample_target(spark, sf):
    """A sample of feature rows with their targets back."""
    splits = doc_splits(spark, sf).filter(F.col("data_split") == "train")
    sample = sample_rows(splits.select("doc_id", *ALL_DOC), "doc_id", SAMPLE_ROWS, SEED)
    return align_sample_target(sample, splits, "doc_id", DOC_TARGET)


SQL_ALIGN_SAMPLE = S.with_(S.DOC_SPLITS) + f"""SELECT doc_id, {', '.join(ALL_DOC)}, {DOC_TARGET} FROM doc_splits WHERE data_split = 'train'
ORDER BY md5('{SEED}:' || CAST(doc_id AS VARCHAR)), CAST(doc_id AS VARCHAR) LIMIT {SAMPLE_ROWS}"""


def q_run_registry(spark, sf):
    """S9 + S4: two records per run appended as JSON, the last one read back."""
    path = f"{_folder(spark)}/runs-{uuid.uuid4().hex}"
    runs = X.runs_table(spark, sf).withColumnRenamed("training_seconds", "training_wall_clock_seconds")
    io.append_run_records(runs.withColumn("test_rmse", F.lit(-1.0)), path, 1, {"stage": "draft"})
    io.append_run_records(runs, path, 2, {"stage": "final"})
    last = io.latest_run_records(io.read_run_registry(spark, path, lines=True), ["experiment_id", "platform", "feature_set", "best_model"])
    return last.select("experiment_id", "platform", "feature_set", "best_model", "feature_count", F.round("validation_rmse", 6).alias("validation_rmse"),
                       F.round("test_rmse", 6).alias("test_rmse"), F.size("model_features").alias("n_features"), F.col("tags")["stage"].alias("stage"))


SQL_REGISTRY = S.with_(M.RUNS) + """SELECT experiment_id, platform, feature_set, best_model, CAST(feature_count AS BIGINT) AS feature_count,
  round(validation_rmse, 6) AS validation_rmse, round(test_rmse, 6) AS test_rmse, CAST(len(model_features) AS INTEGER) AS n_features,
  'final' AS stage FROM runs"""


# ---- NaN counts as missing -----------------------------------------------------------

def _events(spark, sf):
    """Events in which every seventh value is NaN."""
    nan = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, sf, "events").select("event_id", "event_type", nan.alias("value"))


NULLED = "ev AS (SELECT event_id, event_type, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events)"


def q_nan_statistics(spark, sf):
    """A6 per event type."""
    return target.target_statistics(_events(spark, sf), "value", ["event_type"])


SQL_NAN_STATISTICS = f"""WITH {NULLED} SELECT event_type, count(value) AS target_count, min(value) AS target_min, max(value) AS target_max,
  round(avg(value), 6) AS target_mean, round(median(value), 6) AS target_median, round(stddev_samp(value), 6) AS target_std,
  round(quantile_cont(value, 0.99), 6) AS target_p99 FROM ev GROUP BY event_type"""


def q_nan_missing(spark, sf):
    """A8."""
    return profile.missing_percentage(_events(spark, sf), ["event_type", "value"])


SQL_NAN_MISSING = f"""WITH {NULLED} SELECT 'event_type' AS feature, round(avg(CAST(event_type IS NULL AS DOUBLE)) * 100, 6) AS missing_percentage FROM ev
  UNION ALL SELECT 'value', round(avg(CAST(value IS NULL AS DOUBLE)) * 100, 6) FROM ev"""


def q_nan_audit(spark, sf):
    """NaN is a missing target, not one above the maximum."""
    return target.value_counts(target.audit_target_outliers(_events(spark, sf), "value", 5.0, 20.0), ["target_quality_reason"])


SQL_NAN_AUDIT = f"""WITH {NULLED}, r AS (SELECT CASE WHEN value IS NULL THEN 'missing_target' WHEN value < 5 THEN 'below_minimum'
  WHEN value > 20 THEN 'above_maximum' END AS target_quality_reason FROM ev)
SELECT target_quality_reason, count(*) AS row_count FROM r WHERE target_quality_reason IS NOT NULL GROUP BY 1"""


def q_safe_float(spark, sf):
    """P17 on text: numbers, NaN and text that is no number."""
    text = F.when(F.col("event_id") % 7 == 0, "NaN").when(F.col("event_id") % 5 == 0, F.col("event_type")).otherwise(F.col("user_id").cast("string"))
    return table(spark, sf, "events").select("event_id", safe_float(text).alias("value"))


SQL_SAFE_FLOAT = """SELECT event_id, CASE WHEN event_id % 7 = 0 OR event_id % 5 = 0 THEN NULL ELSE CAST(user_id AS DOUBLE) END AS value FROM events"""


QUERIES = {
    "catalog_roundtrip": (q_catalog_roundtrip, S.with_(S.DOC_SPLITS) + f"SELECT {COLUMNS} FROM doc_splits"),
    "split_export_roundtrip": (q_split_export_roundtrip, S.with_(S.DOC_SPLITS) + f"SELECT {COLUMNS} FROM doc_splits WHERE data_split = 'test'"),
    "report_roundtrip": (q_report_roundtrip, S.with_(S.DOC_SPLITS) + f"""SELECT data_split, count(*) AS rows,
  round(avg({DOC_TARGET}), 6) AS target_mean, max({DOC_TARGET}) AS target_max FROM doc_splits GROUP BY data_split"""),
    "predictions_roundtrip": (q_predictions_roundtrip, S.with_(M.PREDS) +
                              "SELECT model, row_id, round(actual - predicted, 6) AS residual FROM preds WHERE data_split = 'test'"),
    "model_roundtrip": (q_model_roundtrip, SQL_MODEL),
    "candidate_metrics": (q_candidate_metrics, SQL_CANDIDATE),
    "assemble": (q_assemble, S.with_(S.DOC_SPLITS) + "SELECT doc_id, word_count AS slot_0, line_count AS slot_1 FROM doc_splits"),
    "drop_sparse_applied": (q_drop_sparse, S.with_(S.DOC_SPLITS) + f"SELECT doc_id, word_count, line_count, lang, source, {DOC_TARGET}, data_split FROM doc_splits"),
    "align_sample_target": (q_align_sample_target, SQL_ALIGN_SAMPLE),
    "run_registry": (q_run_registry, SQL_REGISTRY),
    "nan_statistics": (q_nan_statistics, SQL_NAN_STATISTICS),
    "nan_missing_percentage": (q_nan_missing, SQL_NAN_MISSING),
    "nan_outlier_audit": (q_nan_audit, SQL_NAN_AUDIT),
    "safe_float": (q_safe_float, SQL_SAFE_FLOAT),
}
