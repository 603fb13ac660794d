"""Registered queries for profiling, metrics, leaderboards and comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabready.functions.arithmetic import percent_change
from tabready.operators import compare, leaderboard as L, metrics, moments, profile
from tabready.operators.compare import EXP
from tabready.plans import model_sql as M
from tabready.plans import models as X
from tabready.plans import sql as S
from tabready.plans.standins import DOC_CATEGORICAL, DOC_NUMERIC, DOC_TARGET, doc_splits, line_contract, raw_lines

ARR = "array_to_string({c}, ',') AS {c}"


def _flat(df, *cols):
    return df.withColumns({c: F.array_join(c, ",") for c in cols})


# ---- profiling ---------------------------------------------------------------

def q_column_profile(spark, sf):
    """A1 over every column of the raw lineitem table."""
    c = line_contract()
    return profile.column_profile(raw_lines(spark, sf), c.target, c.components, [c.identifier])


def _profile_sql() -> str:
    cols = ["row_key", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey", "l_suppkey",
            "l_linenumber", "l_returnflag", "l_linestatus"]
    types = {"row_key": ("string", False), "l_quantity": ("double", True), "l_extendedprice": ("double", True),
             "l_discount": ("double", True), "l_tax": ("double", True), "l_partkey": ("bigint", True),
             "l_suppkey": ("bigint", True), "l_linenumber": ("int", True), "l_returnflag": ("string", False),
             "l_linestatus": ("string", False)}
    roles = {"row_key": "identifier", "l_quantity": "target_component", "l_extendedprice": "target_component",
             "l_discount": "target_component", "l_tax": "target_component"}
    cells = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value, "
        f"{'CAST(' + c + ' AS DOUBLE)' if types[c][1] else 'CAST(NULL AS DOUBLE)'} AS num FROM raw" for c in cols)
    meta = ", ".join(f"({i}, '{c}', '{types[c][0]}', '{roles.get(c, 'candidate_feature')}', {str(types[c][1]).lower()})"
                     for i, c in enumerate(cols))
    return S.with_(S.RAW) + f""", cells AS ({cells}),
pairs AS (SELECT col, value, count(*) AS n, min(num) AS num FROM cells GROUP BY col, value),
stats AS (
  SELECT col, sum(n) AS row_count, coalesce(sum(CASE WHEN value IS NOT NULL THEN n END), 0) AS non_null_count,
         coalesce(sum(CASE WHEN value IS NULL THEN n END), 0) AS missing_count, count(value) AS unique_count,
         coalesce(sum(CASE WHEN regexp_full_match({S.strip('value')}, '{_num_pattern()}') THEN n END), 0) AS text_rows
  FROM pairs GROUP BY col),
samples AS (
  SELECT col, string_agg(left(value, 100), ' | ' ORDER BY rn) AS sample_values FROM (
    SELECT col, value, row_number() OVER (PARTITION BY col ORDER BY num ASC NULLS LAST, value) AS rn
    FROM pairs WHERE value IS NOT NULL) WHERE rn <= 3 GROUP BY col),
meta AS (SELECT * FROM (VALUES {meta}) AS t(position, col, raw_dtype, role, is_numeric))
SELECT CAST(m.position AS INTEGER) AS position, m.col AS "column", m.raw_dtype, m.role,
  CAST(row_count AS BIGINT) AS row_count, CAST(non_null_count AS BIGINT) AS non_null_count,
  CAST(missing_count AS BIGINT) AS missing_count,
  round(missing_count * 100.0 / row_count, 4) AS missing_percentage, CAST(unique_count AS BIGINT) AS unique_count,
  round(CASE WHEN non_null_count > 0 THEN unique_count / non_null_count ELSE 0.0 END, 6) AS unique_ratio,
  round(CASE WHEN m.is_numeric THEN 1.0 ELSE text_rows / row_count END, 6) AS numeric_parse_rate,
  unique_count <= 1 AS is_constant,
  unique_count > 100 AND (CASE WHEN non_null_count > 0 THEN unique_count / non_null_count ELSE 0.0 END) > 0.5
    AS is_high_cardinality,
  coalesce(sample_values, '') AS sample_values
FROM meta m JOIN stats s ON m.col = s.col LEFT JOIN samples p ON m.col = p.col"""


def _num_pattern():
    from tabready.functions.cleaning import NUMBER_PATTERN

    return NUMBER_PATTERN


SQL_PROFILE = _profile_sql()


def q_draft_feature_contract(spark, sf):
    """F14 over the raw lineitem profile."""
    return profile.draft_feature_contract(q_column_profile(spark, sf))


SQL_DRAFT = "WITH prof AS (\n" + SQL_PROFILE + """)
SELECT "column", role, raw_dtype, missing_percentage, unique_count, numeric_parse_rate,
  CASE WHEN role IN ('target', 'target_component', 'identifier', 'metadata') THEN 'exclude'
       WHEN is_constant THEN 'exclude'
       WHEN is_high_cardinality AND numeric_parse_rate < 0.90 THEN 'review' ELSE 'candidate' END AS recommended_action,
  CASE WHEN role IN ('target', 'target_component', 'identifier', 'metadata') THEN 'role:' || role
       WHEN is_constant THEN 'one value'
       WHEN is_high_cardinality AND numeric_parse_rate < 0.90 THEN 'many text values'
       ELSE 'usable' END AS reason
FROM prof"""


def _doc_train(spark, sf):
    return doc_splits(spark, sf).filter(F.col("data_split") == "train")


DOC_TRAIN = S.DOC_SPLITS + ",\ntrain AS (SELECT * FROM doc_splits WHERE data_split = 'train')"
ALL_DOC = [*DOC_NUMERIC, *DOC_CATEGORICAL]


def q_missing_percentage(spark, sf):
    """A8 on the documents train split (labels are sparse)."""
    return profile.missing_percentage(_doc_train(spark, sf), ALL_DOC)


SQL_MISSING = S.with_(DOC_TRAIN) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(avg(CAST({c} IS NULL AS DOUBLE)) * 100.0, 6) AS missing_percentage FROM train"
    for c in ALL_DOC)


def q_categorical_cardinality(spark, sf):
    """A9 on the documents train split."""
    return profile.categorical_cardinality(_doc_train(spark, sf), DOC_CATEGORICAL)


SQL_CARD = S.with_(DOC_TRAIN) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, CAST(count(DISTINCT {c}) AS BIGINT) AS distinct_values FROM train"
    for c in DOC_CATEGORICAL)


def q_target_correlation(spark, sf):
    """A10 on the documents train split."""
    return profile.target_correlation(_doc_train(spark, sf), DOC_NUMERIC, DOC_TARGET)


SQL_CORR = S.with_(DOC_TRAIN + M.TOP) + "SELECT feature, abs_correlation FROM corrs"


def q_drop_sparse_features(spark, sf):
    """missing fraction per feature on the filtered rows and whether it is kept at 70 %."""
    return profile.sparse_feature_report(doc_splits(spark, sf), ALL_DOC, 0.70)


SQL_SPARSE = S.with_(S.DOC_SPLITS) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(avg(CAST({c} IS NULL AS DOUBLE)), 6) AS missing_fraction, "
    f"avg(CAST({c} IS NULL AS DOUBLE)) <= 0.7 AS kept FROM doc_splits" for c in ALL_DOC)


def q_data_insights(spark, sf):
    """Split sizes, feature counts and train-split insights, long form."""
    return profile.data_insights(doc_splits(spark, sf), ALL_DOC, DOC_NUMERIC, DOC_CATEGORICAL, DOC_TARGET)


SQL_INSIGHTS = S.with_(DOC_TRAIN + M.TOP) + f"""SELECT 'row_counts' AS section, data_split AS name,
  CAST(count(*) AS DOUBLE) AS value FROM doc_splits GROUP BY data_split
UNION ALL SELECT 'feature_counts', 'feature_count', {float(len(ALL_DOC))}
UNION ALL SELECT 'feature_counts', 'numeric_feature_count', {float(len(DOC_NUMERIC))}
UNION ALL SELECT 'feature_counts', 'categorical_feature_count', {float(len(DOC_CATEGORICAL))}
UNION ALL SELECT 'target_statistics_train', 'target_min', min(n_chars) FROM train
UNION ALL SELECT 'target_statistics_train', 'target_max', max(n_chars) FROM train
UNION ALL SELECT 'target_statistics_train', 'target_mean', round(avg(n_chars), 6) FROM train
UNION ALL SELECT 'target_statistics_train', 'target_median', round(median(n_chars), 6) FROM train
UNION ALL SELECT 'target_statistics_train', 'target_std', round(stddev_samp(n_chars), 6) FROM train
UNION ALL """ + "\nUNION ALL ".join(
    f"SELECT 'missing_percentage_train', '{c}', round(avg(CAST({c} IS NULL AS DOUBLE)) * 100.0, 6) FROM train"
    for c in ALL_DOC) + "\nUNION ALL " + "\nUNION ALL ".join(
    f"SELECT 'categorical_cardinality_train', '{c}', CAST(count(DISTINCT {c}) AS DOUBLE) FROM train"
    for c in DOC_CATEGORICAL) + "\nUNION ALL SELECT 'absolute_numeric_correlation_with_target', feature, " \
                                "abs_correlation FROM corrs"


# ---- metrics and leaderboards --------------------------------------------------

def q_mean_baseline(spark, sf):
    """The train mean predicted for every document."""
    return X.predictions(spark, sf).filter(F.col("model") == "mean")


SQL_MEAN = S.with_(M.PREDS) + "SELECT * FROM preds WHERE model = 'mean'"


def q_regression_metrics(spark, sf):
    """A12 per candidate and split."""
    return metrics.regression_metrics(X.predictions(spark, sf))


SQL_METRICS = S.with_(M.PREDS) + M.metrics_sql()


def q_model_validation_table(spark, sf):
    """The candidate leaderboard."""
    return X.leaderboard(spark, sf)


SQL_LB = S.with_(M.LEADERBOARD) + "SELECT * FROM leaderboard"


def q_rank_leaderboard(spark, sf):
    """Validation rank 1..n by (RMSE, model)."""
    return L.rank_leaderboard(X.experiment_leaderboard(spark, sf), by=[EXP]).select(EXP, "model", "validation_rmse", "validation_rank")


SQL_RANK_LB = S.with_(M.EXP_LEADERBOARD) + """SELECT experiment_id, model, validation_rmse,
  CAST(row_number() OVER (PARTITION BY experiment_id ORDER BY validation_rmse ASC NULLS LAST, model) AS INTEGER) AS validation_rank
FROM exp_leaderboard"""


def q_negated_score(spark, sf):
    """A higher-is-better score column turned back into RMSE."""
    lb = X.leaderboard(spark, sf).select("model", (-F.col("validation_rmse")).alias("score_val"),
                                         (-F.col("test_rmse")).alias("score_test"))
    return L.normalize_score_leaderboard(lb)


SQL_NEGATED = S.with_(M.LEADERBOARD) + """SELECT model, -validation_rmse AS score_val, -test_rmse AS score_test,
  validation_rmse, test_rmse FROM leaderboard"""


def q_top_models_by_score(spark, sf):
    """Three best candidates."""
    return L.top_models_by_score(X.experiment_leaderboard(spark, sf), 3, by=[EXP]).select(EXP, "model", "validation_rmse", "score_rank")


SQL_TOP_SCORE = S.with_(M.EXP_LEADERBOARD) + """SELECT * FROM (SELECT experiment_id, model, validation_rmse,
  CAST(row_number() OVER (PARTITION BY experiment_id ORDER BY validation_rmse ASC NULLS LAST, model) AS INTEGER) AS score_rank
  FROM exp_leaderboard)
WHERE score_rank <= 3"""


def q_top_models_by_training_speed(spark, sf):
    """Three fastest to fit (ties by RMSE, name)."""
    return L.top_models_by_training_speed(X.experiment_leaderboard(spark, sf), 3, time_col="fit_cells", by=[EXP]).select(
        EXP, "model", "fit_cells", "validation_rmse", "speed_rank")


SQL_TOP_FIT = S.with_(M.EXP_LEADERBOARD) + """SELECT * FROM (SELECT experiment_id, model, CAST(fit_cells AS DOUBLE) AS fit_cells, validation_rmse,
  CAST(row_number() OVER (PARTITION BY experiment_id ORDER BY fit_cells, validation_rmse ASC NULLS LAST, model) AS INTEGER) AS speed_rank
  FROM exp_leaderboard WHERE fit_cells IS NOT NULL) WHERE speed_rank <= 3"""


def q_top_models_by_prediction_speed(spark, sf):
    """Three fastest per predicted row."""
    return L.top_models_by_prediction_speed(X.experiment_leaderboard(spark, sf), 3, time_col="predict_cells_per_row", by=[EXP]).select(
        EXP, "model", "predict_cells_per_row", "validation_rmse", "prediction_speed_rank")


SQL_TOP_PRED = S.with_(M.EXP_LEADERBOARD) + """SELECT * FROM (SELECT experiment_id, model, CAST(predict_cells_per_row AS DOUBLE) AS predict_cells_per_row,
  validation_rmse, CAST(row_number() OVER (PARTITION BY experiment_id ORDER BY predict_cells_per_row, validation_rmse ASC NULLS LAST, model) AS INTEGER)
    AS prediction_speed_rank FROM exp_leaderboard WHERE predict_cells_per_row IS NOT NULL)
WHERE prediction_speed_rank <= 3"""


def _importance(spark, sf):
    """|correlation| with the target on the train rows of each experiment."""
    corr = moments.feature_correlations(X.experiment_moments(spark, sf).filter("data_split = 'train'"), X.SEARCH_FEATURES)
    return corr.select(EXP, F.col("feature").alias("variable"), F.round(F.abs("correlation"), 6).alias("relative_importance"))


IMPORTANCE_CTE = S.with_(S.DOC_SPLITS) + """, d AS (SELECT *, word_count / line_count AS words_per_line FROM doc_splits
  WHERE data_split = 'train' AND lang IS NOT NULL),
imp AS (""" + "\nUNION ALL ".join(
    f"SELECT '{X.EXPERIMENT}_' || lang AS experiment_id, '{c}' AS variable, round(abs(corr({c}, n_chars)), 6) AS relative_importance FROM d GROUP BY lang"
    for c in X.SEARCH_FEATURES) + ")\n"


def q_rank_importance(spark, sf):
    """W9 on correlation-based importances."""
    return L.rank_importance(_importance(spark, sf), by=[EXP], feature="variable")


SQL_RANK_IMP = IMPORTANCE_CTE + """SELECT experiment_id, variable, relative_importance,
  CAST(row_number() OVER (PARTITION BY experiment_id ORDER BY relative_importance DESC, variable) AS INTEGER) AS importance_rank FROM imp"""


def q_scaled_importance(spark, sf):
    """Value / max and value / sum."""
    return L.scaled_importance(_importance(spark, sf), by=[EXP]).withColumns(
        {c: F.round(c, 9) for c in ("scaled_importance", "percentage")})


SQL_SCALED = IMPORTANCE_CTE + """SELECT experiment_id, variable, relative_importance,
  round(relative_importance / max(relative_importance) OVER (PARTITION BY experiment_id), 9) AS scaled_importance,
  round(relative_importance / sum(relative_importance) OVER (PARTITION BY experiment_id), 9) AS percentage FROM imp"""


def q_top_features(spark, sf):
    """The experiment's top-2 features as an ordered list."""
    return _flat(X.experiment_top_features(spark, sf), "top_features")


SQL_TOP_FEATURES = S.with_(DOC_TRAIN + M.TOP) + f"""SELECT '{X.EXPERIMENT}' AS experiment_id,
  array_to_string(top_features, ',') AS top_features FROM top"""


def q_actual_vs_predicted_grid(spark, sf):
    """20 x 20 bin counts per candidate on the test split."""
    preds = X.predictions(spark, sf).filter(F.col("data_split") == "test")
    return metrics.actual_vs_predicted_grid(preds, 20)


SQL_GRID = S.with_(M.PREDS) + """, t AS (SELECT * FROM preds WHERE data_split = 'test'),
b AS (SELECT model, least(min(actual), min(predicted)) AS lo, greatest(max(actual), max(predicted)) AS hi
      FROM t GROUP BY model),
j AS (SELECT t.*, b.lo, b.hi, (b.hi - b.lo) / 20 AS width FROM t JOIN b ON t.model = b.model)
SELECT model, round(lo, 6) AS lo, round(hi, 6) AS hi,
  CAST(least(CASE WHEN width > 0 THEN floor((actual - lo) / width) ELSE 0 END, 19) AS INTEGER) AS actual_bin,
  CAST(least(CASE WHEN width > 0 THEN floor((predicted - lo) / width) ELSE 0 END, 19) AS INTEGER) AS predicted_bin,
  CAST(count(*) AS BIGINT) AS points
FROM j GROUP BY ALL"""


# ---- runs and comparison -------------------------------------------------------

RUN_COLS = ["experiment_id", "platform", "feature_set", "feature_count", "best_model", "validation_rmse",
            "test_rmse", "test_mae", "test_r2", "training_cells", "prediction_cells", "is_automl"]


def q_normalize_run_rows(spark, sf):
    """AutoML and baseline summaries as uniform run rows."""
    return _flat(X.runs_table(spark, sf), "model_features")


SQL_RUNS = S.with_(M.RUNS) + f"SELECT {', '.join(RUN_COLS)}, {ARR.format(c='model_features')} FROM runs"


def q_rank_runs(spark, sf):
    """Five min-ranks per experiment."""
    return L_cols(compare.rank_runs(X.runs_table(spark, sf), tuple(X.COSTS)))


def L_cols(df):
    return df.select("platform", "feature_set", "best_model", "validation_rank", "test_rmse_rank", "test_r2_rank",
                     "training_speed_rank", "prediction_speed_rank")


SQL_RANK_RUNS = S.with_(M.RUNS) + """SELECT platform, feature_set, best_model,
  CAST(rank() OVER (ORDER BY validation_rmse) AS INTEGER) AS validation_rank,
  CAST(rank() OVER (ORDER BY test_rmse) AS INTEGER) AS test_rmse_rank,
  CAST(rank() OVER (ORDER BY test_r2 DESC) AS INTEGER) AS test_r2_rank,
  CAST(rank() OVER (ORDER BY training_cells) AS INTEGER) AS training_speed_rank,
  CAST(rank() OVER (ORDER BY prediction_cells) AS INTEGER) AS prediction_speed_rank FROM runs"""


def q_compare_to_baseline(spark, sf):
    """Percent change of each run against the baseline model."""
    out = compare.compare_to_baseline(X.runs_table(spark, sf), X.BASELINE_MODEL)
    return out.select("platform", "feature_set", "best_model", "is_automl",
                      *[c for c in out.columns if c.endswith("_vs_baseline_percent")])


def _pct(new: str, ref: str) -> str:
    return f"({new} - {ref}) / abs({ref}) * 100.0"


SQL_BASELINE = S.with_(M.RUNS) + f""", b AS (SELECT * FROM runs WHERE best_model = '{X.BASELINE_MODEL}' AND NOT is_automl)
SELECT r.platform, r.feature_set, r.best_model, r.is_automl,
  {_pct('r.validation_rmse', 'b.validation_rmse')} AS validation_rmse_change_vs_baseline_percent,
  {_pct('r.test_rmse', 'b.test_rmse')} AS test_rmse_change_vs_baseline_percent,
  {_pct('r.test_mae', 'b.test_mae')} AS test_mae_change_vs_baseline_percent,
  CASE WHEN b.test_r2 <> 0 THEN {_pct('r.test_r2', 'b.test_r2')} END AS test_r2_change_vs_baseline_percent
FROM runs r JOIN b ON r.experiment_id = b.experiment_id"""


def q_full_vs_reduced(spark, sf):
    """Reduced-feature runs against their platform's all-features run."""
    return compare.full_vs_reduced(X.runs_table(spark, sf), tuple(X.COSTS))


PAIRS = """, pairs AS (
  SELECT r.*, f.best_model AS full_best_model, f.feature_count AS full_feature_count,
    f.validation_rmse AS full_validation_rmse, f.test_rmse AS full_test_rmse, f.test_mae AS full_test_mae,
    f.test_r2 AS full_test_r2, f.training_cells AS full_training_cells, f.prediction_cells AS full_prediction_cells
  FROM runs r JOIN (SELECT *, count(*) OVER (PARTITION BY experiment_id, platform) AS n FROM runs
                    WHERE is_automl AND feature_set = 'all_features') f
    ON r.experiment_id = f.experiment_id AND r.platform = f.platform
  WHERE r.is_automl AND r.feature_set = 'top_features' AND f.n = 1)"""

SQL_FULL_REDUCED = S.with_(M.RUNS + PAIRS) + f"""SELECT experiment_id, platform, best_model, feature_count, validation_rmse,
  {_pct('validation_rmse', 'full_validation_rmse')} AS validation_degradation_percent,
  {_pct('training_cells', 'full_training_cells')} AS training_time_change_percent FROM pairs"""


def q_compare_feature_sets(spark, sf):
    """Top-minus-all deltas and assessment."""
    return compare.compare_feature_sets(X.runs_table(spark, sf), tuple(X.COSTS))


SQL_FEATURE_SETS = S.with_(M.RUNS + PAIRS) + """SELECT experiment_id, platform,
  full_feature_count AS all_features_count, feature_count AS top_features_count,
  full_best_model AS all_features_best_model, best_model AS top_features_best_model,
""" + ",\n".join(f"  {c} - full_{c} AS {c}_delta_top_minus_all" for c in (*compare.SCORES, *X.COSTS)) + """,
  CASE WHEN validation_rmse - full_validation_rmse < 0 THEN 'improved'
       WHEN validation_rmse - full_validation_rmse > 0 THEN 'degraded' ELSE 'maintained' END
    AS validation_performance_assessment
FROM pairs"""


def q_feature_overlap(spark, sf):
    """Each run's features against the best predictive run's features."""
    runs = X.runs_table(spark, sf)
    rec = compare.build_recommendation(runs, costs=tuple(X.COSTS)).select("experiment_id", "best_platform", "best_feature_set")
    best = runs.join(rec, "experiment_id").filter(
        (F.col("platform") == F.col("best_platform")) & (F.col("feature_set") == F.col("best_feature_set"))
    ).select("experiment_id", F.col("model_features").alias("second_features"))
    pairs = runs.select("experiment_id", "platform", "feature_set", "best_model",
                        F.col("model_features").alias("first_features")).join(best, "experiment_id")
    out = compare.feature_overlap(pairs)
    return _flat(out, "first_features", "second_features", "shared_features")


SQL_OVERLAP = S.with_(M.RUNS) + """, best AS (
  SELECT experiment_id, model_features AS second_features FROM (
    SELECT *, row_number() OVER (PARTITION BY experiment_id
      ORDER BY validation_rmse, test_rmse, training_cells, platform, feature_set) AS rn
    FROM runs WHERE is_automl) WHERE rn = 1),
p AS (SELECT r.experiment_id, r.platform, r.feature_set, r.best_model, r.model_features AS first_features,
        b.second_features FROM runs r JOIN best b ON r.experiment_id = b.experiment_id)
SELECT experiment_id, platform, feature_set, best_model,
  array_to_string(first_features, ',') AS first_features, array_to_string(second_features, ',') AS second_features,
  array_to_string(list_sort(list_intersect(first_features, second_features)), ',') AS shared_features,
  CAST(len(list_intersect(first_features, second_features)) AS INTEGER) AS shared_feature_count,
  CASE WHEN len(list_distinct(list_concat(first_features, second_features))) > 0
       THEN len(list_intersect(first_features, second_features))
            / len(list_distinct(list_concat(first_features, second_features))) ELSE 0.0 END AS jaccard_similarity
FROM p"""


def q_recommendation(spark, sf):
    """Best predictive, fastest and best reduced run within 2 %."""
    return compare.build_recommendation(X.runs_table(spark, sf), 2.0, tuple(X.COSTS))


SQL_RECOMMEND = S.with_(M.RUNS + PAIRS) + f""", red AS (
  SELECT experiment_id, platform, best_model, feature_count, validation_rmse,
    {_pct('validation_rmse', 'full_validation_rmse')} AS deg, {_pct('training_cells', 'full_training_cells')} AS tchg
  FROM pairs),
redb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY experiment_id ORDER BY deg, validation_rmse, tchg, platform) AS rn
         FROM red WHERE deg <= 2.0) WHERE rn = 1),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY experiment_id
         ORDER BY validation_rmse, test_rmse, training_cells, platform, feature_set) AS rn FROM runs WHERE is_automl) WHERE rn = 1),
fast AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY experiment_id
         ORDER BY training_cells, validation_rmse, platform, feature_set) AS rn FROM runs WHERE is_automl) WHERE rn = 1),
ex AS (SELECT DISTINCT experiment_id FROM runs)
SELECT ex.experiment_id,
  best.platform AS best_platform, best.feature_set AS best_feature_set, best.feature_count AS best_feature_count,
  best.best_model AS best_best_model, best.validation_rmse AS best_validation_rmse, best.test_rmse AS best_test_rmse,
  best.test_mae AS best_test_mae, best.test_r2 AS best_test_r2,
  fast.platform AS fastest_platform, fast.feature_set AS fastest_feature_set,
  fast.training_cells AS fastest_training_cells, fast.validation_rmse AS fastest_validation_rmse,
  redb.platform AS reduced_platform, redb.best_model AS reduced_best_model, redb.feature_count AS reduced_feature_count,
  redb.validation_rmse AS reduced_validation_rmse, redb.deg AS reduced_validation_degradation_percent,
  redb.tchg AS reduced_training_time_change_percent,
  'PASS' AS status, 2.0::DOUBLE AS reduced_feature_tolerance_percent
FROM ex LEFT JOIN best ON ex.experiment_id = best.experiment_id LEFT JOIN fast ON ex.experiment_id = fast.experiment_id
LEFT JOIN redb ON ex.experiment_id = redb.experiment_id"""


def q_percent_change(spark, sf):
    """Validation RMSE of every candidate against the mean baseline's."""
    lb = X.leaderboard(spark, sf)
    ref = lb.filter(F.col("model") == "mean").select("validation_rmse").scalar()
    return lb.select("model", percent_change(F.col("validation_rmse"), ref).alias("validation_rmse_change_percent"))


SQL_PCT = S.with_(M.LEADERBOARD) + f"""SELECT model, {_pct('validation_rmse', "(SELECT validation_rmse FROM leaderboard WHERE model = 'mean')")}
  AS validation_rmse_change_percent FROM leaderboard"""


QUERIES = {
    "column_profile": (q_column_profile, SQL_PROFILE),
    "draft_feature_contract": (q_draft_feature_contract, SQL_DRAFT),
    "missing_percentage": (q_missing_percentage, SQL_MISSING),
    "categorical_cardinality": (q_categorical_cardinality, SQL_CARD),
    "target_correlation": (q_target_correlation, SQL_CORR),
    "drop_sparse_features": (q_drop_sparse_features, SQL_SPARSE),
    "data_insights": (q_data_insights, SQL_INSIGHTS),
    "mean_baseline": (q_mean_baseline, SQL_MEAN),
    "regression_metrics": (q_regression_metrics, SQL_METRICS),
    "model_validation_table": (q_model_validation_table, SQL_LB),
    "rank_leaderboard": (q_rank_leaderboard, SQL_RANK_LB),
    "negated_score_to_error": (q_negated_score, SQL_NEGATED),
    "top_models_by_score": (q_top_models_by_score, SQL_TOP_SCORE),
    "top_models_by_training_speed": (q_top_models_by_training_speed, SQL_TOP_FIT),
    "top_models_by_prediction_speed": (q_top_models_by_prediction_speed, SQL_TOP_PRED),
    "rank_importance": (q_rank_importance, SQL_RANK_IMP),
    "scaled_importance": (q_scaled_importance, SQL_SCALED),
    "top_features": (q_top_features, SQL_TOP_FEATURES),
    "actual_vs_predicted_grid": (q_actual_vs_predicted_grid, SQL_GRID),
    "normalize_run_rows": (q_normalize_run_rows, SQL_RUNS),
    "rank_runs": (q_rank_runs, SQL_RANK_RUNS),
    "compare_to_baseline": (q_compare_to_baseline, SQL_BASELINE),
    "full_vs_reduced": (q_full_vs_reduced, SQL_FULL_REDUCED),
    "compare_feature_sets": (q_compare_feature_sets, SQL_FEATURE_SETS),
    "feature_overlap": (q_feature_overlap, SQL_OVERLAP),
    "recommendation": (q_recommendation, SQL_RECOMMEND),
    "percent_change": (q_percent_change, SQL_PCT),
}
