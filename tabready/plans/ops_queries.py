"""Registered queries for importance, imputation, encoding, identity,
sources and quality gates (SQL-checkable)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabready.functions.cleaning import parse_numeric_or_time
from tabready.operators import gates, importance, train
from tabready.operators.candidates import fit_candidate
from tabready.operators.features import drop_split_and_filter, project_model_frame, synthesize_identifier
from tabready.operators.metrics import add_residual, align_predictions
from tabready.plans import model_sql as M
from tabready.plans import models as X
from tabready.plans import sql as S
from tabready.plans.standins import (
    DOC_CATEGORICAL, DOC_NUMERIC, DOC_TARGET, LINE_COMPONENTS, SEED, doc_splits, raw_lines, split_lines, table,
)
from tabready.session import ensure_checkpoint_dir
from tabready.sources import io

ALL_DOC = [*DOC_NUMERIC, *DOC_CATEGORICAL]
REPEATS = 3
IMPORTANCE_MODEL = "ols_word_by_lang"


def q_permutation_importance(spark, sf):
    """L10 for the per-language least-squares model on the whole validation split."""
    splits = doc_splits(spark, sf)
    cand = next(c for c in X.CANDIDATES if c.name == IMPORTANCE_MODEL)
    scorer = fit_candidate(splits.filter(F.col("data_split") == "train"), cand, DOC_TARGET)
    return importance.permutation_importance(splits.filter(F.col("data_split") == "validation"), scorer, ALL_DOC, DOC_TARGET, "doc_id", REPEATS, SEED)


_COMBOS = ", ".join(f"('{f}', {r})" for f in ALL_DOC for r in range(1, REPEATS + 1))
_DONOR_COLS = ", ".join(f"{f} AS d_{f}" for f in ALL_DOC)
_SWAP = ", ".join(f"CASE WHEN c._feature = '{f}' THEN d.d_{f} ELSE c.{f} END AS {f}" for f in ALL_DOC)
_FEATS = ", ".join(ALL_DOC)
_ID = "CAST(doc_id AS VARCHAR)"
SQL_PERMUTATION = S.with_(S.DOC_SPLITS) + f""",
train AS (SELECT * FROM doc_splits WHERE data_split = 'train'),
sample AS (SELECT doc_id, n_chars, {_FEATS} FROM doc_splits WHERE data_split = 'validation'),
pos AS (SELECT *, row_number() OVER (ORDER BY md5('{SEED}:' || {_ID}), {_ID}) AS _pos FROM sample),
combos AS (SELECT * FROM (VALUES {_COMBOS}) AS t(_feature, _repeat)),
copies AS (SELECT p.*, c._feature, c._repeat FROM pos p, combos c),
donors AS (SELECT _feature, _repeat,
  row_number() OVER (PARTITION BY _feature, _repeat
    ORDER BY md5('{SEED}:' || _feature || ':' || CAST(_repeat AS VARCHAR) || ':' || {_ID}), {_ID}) AS _pos,
  {_DONOR_COLS} FROM copies),
permuted AS (SELECT c.doc_id, c.n_chars, c._feature, c._repeat, {_SWAP}
  FROM copies c JOIN donors d ON c._feature = d._feature AND c._repeat = d._repeat AND c._pos = d._pos),
allrows AS (SELECT doc_id, n_chars, CAST(NULL AS VARCHAR) AS _feature, 0 AS _repeat, {_FEATS} FROM sample
  UNION ALL SELECT doc_id, n_chars, _feature, _repeat, {_FEATS} FROM permuted),
fit AS (SELECT lang AS k, regr_slope(n_chars, word_count) AS s, regr_intercept(n_chars, word_count) AS i
        FROM train GROUP BY lang),
scored AS (SELECT a.*, CASE WHEN f.s IS NOT NULL THEN f.i + f.s * a.word_count
    ELSE (SELECT regr_intercept(n_chars, word_count) FROM train)
         + (SELECT regr_slope(n_chars, word_count) FROM train) * a.word_count END AS predicted
  FROM allrows a LEFT JOIN fit f ON a.lang = f.k),
rmse AS (SELECT _feature, _repeat, sqrt(avg((n_chars - predicted) * (n_chars - predicted))) AS r
         FROM scored GROUP BY _feature, _repeat),
imp AS (SELECT _feature, r - (SELECT r FROM rmse WHERE _repeat = 0) AS v FROM rmse WHERE _repeat > 0)
SELECT _feature AS feature, round(avg(v), 6) + 0.0 AS importance_mean, round(stddev_pop(v), 6) + 0.0 AS importance_std,
  CAST(count(*) AS BIGINT) AS repeats FROM imp GROUP BY _feature"""


def q_impute_median(spark, sf):
    """L1: sparse label columns filled with their exact train medians."""
    splits = doc_splits(spark, sf)
    fill = train.fit_median_imputer(splits.filter(F.col("data_split") == "train"), ["quality", "toxic"])
    return train.apply_imputer(splits, fill).select("doc_id", "quality", "toxic")


SQL_IMPUTE_MEDIAN = S.with_(S.DOC_SPLITS) + """SELECT doc_id,
  coalesce(quality, (SELECT median(quality) FROM doc_splits WHERE data_split = 'train')) AS quality,
  coalesce(toxic, (SELECT median(toxic) FROM doc_splits WHERE data_split = 'train')) AS toxic
FROM doc_splits"""


def q_impute_most_frequent(spark, sf):
    """L2: label columns filled with their most frequent train value (ties to the smallest)."""
    splits = doc_splits(spark, sf)
    fill = train.fit_mode_imputer(splits.filter(F.col("data_split") == "train"), ["quality", "toxic"])
    return train.apply_imputer(splits, fill).select("doc_id", "quality", "toxic")


def _mode(c):
    return (f"(SELECT {c} FROM doc_splits WHERE data_split = 'train' AND {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, {c} LIMIT 1)")


SQL_IMPUTE_MODE = S.with_(S.DOC_SPLITS) + f"""SELECT doc_id, coalesce(quality, {_mode('quality')}) AS quality,
  coalesce(toxic, {_mode('toxic')}) AS toxic FROM doc_splits"""


def q_one_hot(spark, sf):
    """L3: language one-hot fit on train (alphabetical slots, unseen -> zeros)."""
    splits = doc_splits(spark, sf)
    out = train.one_hot_array(splits, splits.filter(F.col("data_split") == "train"), "lang")
    return out.select("doc_id", "lang", F.array_join(F.transform("lang_one_hot", lambda x: x.cast("string")), ",")
                      .alias("lang_one_hot"))


SQL_ONE_HOT = S.with_(S.DOC_SPLITS) + """, labels AS (
  SELECT list(DISTINCT lang ORDER BY lang) AS l FROM doc_splits WHERE data_split = 'train' AND lang IS NOT NULL)
SELECT doc_id, lang, array_to_string(list_transform((SELECT l FROM labels),
  lambda x: CAST(CASE WHEN x = lang THEN 1.0 ELSE 0.0 END AS VARCHAR)), ',') AS lang_one_hot FROM doc_splits"""


def q_synthesize_identifier(spark, sf):
    """Deterministic row identifiers for order attributes without a key."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    return synthesize_identifier(orders, "row_id")


SQL_SYNTH = """WITH o AS (SELECT o_custkey, o_orderstatus, o_orderpriority,
  md5(to_json({'o_custkey': o_custkey, 'o_orderstatus': o_orderstatus, 'o_orderpriority': o_orderpriority})) AS h
  FROM orders)
SELECT o_custkey, o_orderstatus, o_orderpriority,
  'row_' || h || '_' || CAST(row_number() OVER (PARTITION BY h) - 1 AS VARCHAR) AS row_id FROM o"""


def _fp_sql(src: str, cols: list[str]) -> str:
    obj = ", ".join(f"'{c}': {c}" for c in cols)
    return (f"SELECT CAST(count(*) AS BIGINT) AS row_count, "
            f"bit_xor(('0x' || substr(md5(to_json({{{obj}}})), 1, 15))::BIGINT) AS xor_hash, "
            f"CAST(sum(('0x' || substr(md5(to_json({{{obj}}})), 1, 15))::BIGINT % {io.FINGERPRINT_MOD}) AS BIGINT) "
            f"AS sum_hash FROM {src}")


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


def q_dataset_fingerprint(spark, sf):
    """Order-insensitive fingerprint of the orders table's key columns."""
    return io.dataset_fingerprint(table(spark, sf, "orders").select(*ORDER_COLS))


SQL_FINGERPRINT = _fp_sql("orders", ORDER_COLS)

SPLIT_COLS = ["row_key", "line_total", "data_split"]


def q_evidence_manifest(spark, sf):
    """Q3: rows and fingerprint of the orders table and the split lineitem table."""
    return gates.evidence_manifest({
        "orders": table(spark, sf, "orders").select(*ORDER_COLS),
        "line_splits": split_lines(spark, sf).select(*SPLIT_COLS),
    })


SQL_MANIFEST = S.with_(S.LINE_SPLITS) + f"""SELECT 'orders' AS table_name, * FROM ({_fp_sql('orders', ORDER_COLS)})
UNION ALL SELECT 'line_splits', * FROM ({_fp_sql('line_splits', SPLIT_COLS)})"""


def _export(spark, sf):
    df = split_lines(spark, sf)
    return df.withColumn("data_split", F.when(F.col("data_split") == "validation", "validate").otherwise(
        F.col("data_split")))


def q_validate_modeling_table(spark, sf):
    """F8 on the prepared, split lineitem table."""
    df = split_lines(spark, sf)
    feats = ["l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    return gates.validate_modeling_table(df, "row_key", "line_total", feats, LINE_COMPONENTS)


SQL_VALIDATE = S.with_(S.LINE_SPLITS) + """, t AS (
  SELECT 'non_empty' AS check_name, CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations
  FROM line_splits
  UNION ALL SELECT 'target_present', CAST(count_if(line_total IS NULL) AS BIGINT) FROM line_splits
  UNION ALL SELECT 'identifier_present', CAST(count_if(row_key IS NULL) AS BIGINT) FROM line_splits)
SELECT check_name, violations, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM t"""


def q_validate_split_export(spark, sf):
    """F9 on the export-labelled lineitem splits."""
    return gates.validate_split_export(_export(spark, sf), "row_key", "line_total")


EXPORT_CTES = """, e AS (
  SELECT row_key, line_total, CASE data_split WHEN 'validation' THEN 'validate' ELSE data_split END AS data_split
  FROM line_splits),
per AS (SELECT row_key, count(*) AS n, count(DISTINCT data_split) AS s, count_if(line_total IS NULL) AS t
        FROM e GROUP BY row_key),
lab AS (SELECT data_split FROM e GROUP BY data_split),
t AS (
  SELECT 'non_empty' AS check_name, CAST(CASE WHEN sum(n) IS NULL THEN 1 ELSE 0 END AS BIGINT) AS violations FROM per
  UNION ALL SELECT 'target_present', CAST(coalesce(sum(t), 0) AS BIGINT) FROM per
  UNION ALL SELECT 'identifier_present', CAST(coalesce(sum(CASE WHEN row_key IS NULL THEN n END), 0) AS BIGINT) FROM per
  UNION ALL SELECT 'identifiers_in_multiple_splits', CAST(count_if(s > 1) AS BIGINT) FROM per
  UNION ALL SELECT 'duplicate_identifiers', CAST(count_if(row_key IS NOT NULL AND n > 1) AS BIGINT) FROM per
  UNION ALL SELECT 'label_set', CAST(count_if(data_split NOT IN ('train', 'validate', 'test') OR data_split IS NULL)
    + 3 - count_if(data_split IN ('train', 'validate', 'test')) AS BIGINT) FROM lab),
chk AS (SELECT check_name, violations, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM t)"""

SQL_EXPORT = S.with_(S.LINE_SPLITS + EXPORT_CTES) + "SELECT * FROM chk"


def _expectations(spark, sf):
    return gates.expectation_table([
        gates.row_count_check(split_lines(spark, sf), "line_splits", 1000),
        gates.row_count_check(table(spark, sf, "orders"), "orders", 1000),
        gates.status_check(gates.validate_split_export(_export(spark, sf), "row_key", "line_total"),
                           "line_splits_export"),
        gates.status_check(X.runs_table(spark, sf).withColumn(
            "status", F.when(F.col("validation_rmse") > F.col("test_rmse") * 2, "WARN").otherwise("PASS")),
            "runs", warn_values=["WARN"]),
    ])


def q_expectation_table(spark, sf):
    """Q1: row-count, export-validation and run-status checks as one table."""
    return _expectations(spark, sf)


EXPECT_CTES = """, q AS (
  SELECT 'line_splits' AS table_name, 'rows >= 1000' AS check_name,
    CASE WHEN count(*) >= 1000 THEN 'PASS' ELSE 'FAIL' END AS status, 'rows=' || CAST(count(*) AS VARCHAR) AS details
  FROM line_splits
  UNION ALL SELECT 'orders', 'rows >= 1000', CASE WHEN count(*) >= 1000 THEN 'PASS' ELSE 'FAIL' END,
    'rows=' || CAST(count(*) AS VARCHAR) FROM orders
  UNION ALL SELECT 'line_splits_export', 'status == PASS',
    CASE WHEN count_if(status = 'FAIL') > 0 THEN 'FAIL' ELSE 'PASS' END,
    'failed=' || CAST(count_if(status = 'FAIL') AS VARCHAR) || ' of ' || CAST(count(*) AS VARCHAR) FROM chk
  UNION ALL SELECT 'runs', 'status == PASS',
    CASE WHEN count_if(validation_rmse > test_rmse * 2) > 0 THEN 'WARN' ELSE 'PASS' END,
    'failed=0 of ' || CAST(count(*) AS VARCHAR) FROM runs)"""

SQL_EXPECT = S.with_(S.LINE_SPLITS + EXPORT_CTES, M.RUNS + EXPECT_CTES) + "SELECT * FROM q"
SQL_GATE = S.with_(S.LINE_SPLITS + EXPORT_CTES, M.RUNS + EXPECT_CTES) + """SELECT CAST(count(*) AS BIGINT) AS checks,
  CAST(count_if(status = 'FAIL') AS BIGINT) AS failed, CAST(count_if(status = 'WARN') AS BIGINT) AS warnings,
  CASE WHEN count_if(status = 'FAIL') > 0 THEN 'FAIL' WHEN count_if(status = 'WARN') > 0 THEN 'PASS_WITH_WARNINGS'
       ELSE 'PASS' END AS gate_status FROM q"""


def q_gate_status(spark, sf):
    """Q2 over the expectation table."""
    return gates.gate_status(_expectations(spark, sf))


def q_drop_null_metric_rows(spark, sf):
    """leaderboard rows with timing (a model without a fit time is dropped)."""
    lb = X.leaderboard(spark, sf).withColumn(
        "fit_cells", F.when(F.col("model") != "mean", F.col("fit_cells")))
    return gates.drop_null_metric_rows(lb, ["fit_cells"]).select("model", "fit_cells")


SQL_DROP_NULL = S.with_(M.LEADERBOARD) + "SELECT model, fit_cells FROM leaderboard WHERE model <> 'mean'"


def q_align_predictions(spark, sf):
    """Test actuals matched to one model's predictions by identifier."""
    actuals = doc_splits(spark, sf).filter(F.col("data_split") == "test").select(
        F.col("doc_id").alias("row_id"), F.col("n_chars").alias("actual"))
    preds = X.predictions(spark, sf).filter((F.col("model") == "ols_word_count") & (F.col("data_split") == "test"))
    aligned = align_predictions(actuals, preds.select("row_id", "predicted"), "row_id")
    return aligned.withColumn("predicted", F.round("predicted", 6))


SQL_ALIGN = S.with_(M.PREDS) + """SELECT coalesce(a.row_id, p.row_id) AS row_id, a.actual, round(p.predicted, 6) AS predicted FROM
  (SELECT doc_id AS row_id, n_chars AS actual FROM doc_splits WHERE data_split = 'test') a FULL OUTER JOIN
  (SELECT row_id, predicted FROM preds WHERE model = 'ols_word_count' AND data_split = 'test') p ON a.row_id = p.row_id"""


def q_add_residual(spark, sf):
    """Residuals of the mean baseline."""
    return add_residual(X.predictions(spark, sf).filter(F.col("model") == "mean"))


SQL_RESIDUAL = S.with_(M.PREDS) + "SELECT *, actual - predicted AS residual FROM preds WHERE model = 'mean'"


def q_project_model_frame(spark, sf):
    """``[id, features..., target]`` of the documents table."""
    return project_model_frame(doc_splits(spark, sf), ALL_DOC, DOC_TARGET, "doc_id")


SQL_PROJECT = S.with_(S.DOC_SPLITS) + f"SELECT doc_id, {_FEATS}, n_chars FROM doc_splits"


def q_drop_split_and_filter(spark, sf):
    """The test split without its label column."""
    return drop_split_and_filter(doc_splits(spark, sf), "test")


SQL_TEST_SPLIT = S.with_(S.DOC_SPLITS) + "SELECT * EXCLUDE (data_split) FROM doc_splits WHERE data_split = 'test'"


def q_csv_roundtrip(spark, sf):
    """S5 + S1 + P4: raw lineitem written as CSV, read back all-string, parsed."""
    base = ensure_checkpoint_dir(spark)
    cols = ["row_key", *LINE_COMPONENTS]
    path = io.write_table(raw_lines(spark, sf).select(*cols), base + "/csv", "raw_lines", ["csv"])["csv"]
    back = io.read_csv_table(spark, path, cols)
    return back.select("row_key", *[parse_numeric_or_time(c).alias(c) for c in LINE_COMPONENTS])


SQL_CSV = S.with_(S.RAW) + f"SELECT row_key, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in LINE_COMPONENTS)} FROM raw"


QUERIES = {
    "permutation_importance": (q_permutation_importance, SQL_PERMUTATION),
    "impute_median": (q_impute_median, SQL_IMPUTE_MEDIAN),
    "impute_most_frequent": (q_impute_most_frequent, SQL_IMPUTE_MODE),
    "one_hot": (q_one_hot, SQL_ONE_HOT),
    "synthesize_identifier": (q_synthesize_identifier, SQL_SYNTH),
    "dataset_fingerprint": (q_dataset_fingerprint, SQL_FINGERPRINT),
    "evidence_manifest": (q_evidence_manifest, SQL_MANIFEST),
    "validate_modeling_table": (q_validate_modeling_table, SQL_VALIDATE),
    "validate_split_export": (q_validate_split_export, SQL_EXPORT),
    "expectation_table": (q_expectation_table, SQL_EXPECT),
    "gate_status": (q_gate_status, SQL_GATE),
    "drop_null_metric_rows": (q_drop_null_metric_rows, SQL_DROP_NULL),
    "align_predictions": (q_align_predictions, SQL_ALIGN),
    "add_residual": (q_add_residual, SQL_RESIDUAL),
    "project_model_frame": (q_project_model_frame, SQL_PROJECT),
    "drop_split_and_filter": (q_drop_split_and_filter, SQL_TEST_SPLIT),
    "csv_roundtrip": (q_csv_roundtrip, SQL_CSV),
}
