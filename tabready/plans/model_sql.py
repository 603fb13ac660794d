"""DuckDB oracle fragments for the documents experiment (mirrors ``models``)."""

from __future__ import annotations

from tabready.plans import sql as S
from tabready.plans.models import ALL_DOC_FEATURES, BASELINES, CANDIDATES, EXPERIMENT, PLATFORMS, TOP_K
from tabready.plans.standins import DOC_NUMERIC

_KEYS = {
    "mean_by_lang": "{t}lang",
    "mean_by_source": "{t}source",
    "mean_by_word_bucket": "floor({t}word_count / 50)",
    "mean_by_line_bucket": "floor({t}line_count / 5)",
    "ols_word_by_lang": "{t}lang",
}


def _pred_sql(name: str, kind: str, x: str | None) -> str:
    base = "SELECT '{n}' AS model, d.doc_id AS row_id, d.data_split, d.n_chars AS actual, {p} AS predicted FROM doc_splits d"
    if kind == "mean":
        return base.format(n=name, p="(SELECT m FROM gm)")
    if kind == "group_mean":
        return (base.format(n=name, p=f"coalesce(f.g, (SELECT m FROM gm))")
                + f" LEFT JOIN (SELECT {_KEYS[name].format(t='')} AS k, avg(n_chars) AS g FROM train GROUP BY 1) f"
                  f" ON {_KEYS[name].format(t='d.')} = f.k")
    if kind == "ols":
        return base.format(
            n=name, p=f"(SELECT regr_intercept(n_chars, {x}) FROM train) + (SELECT regr_slope(n_chars, {x}) FROM train) * d.{x}")
    if kind == "group_ols":
        glob = f"(SELECT regr_intercept(n_chars, {x}) FROM train) + (SELECT regr_slope(n_chars, {x}) FROM train) * d.{x}"
        return (base.format(n=name, p=f"CASE WHEN f.s IS NOT NULL THEN f.i + f.s * d.{x} ELSE {glob} END")
                + f" LEFT JOIN (SELECT {_KEYS[name].format(t='')} AS k, regr_slope(n_chars, {x}) AS s,"
                  f" regr_intercept(n_chars, {x}) AS i FROM train GROUP BY 1) f ON {_KEYS[name].format(t='d.')} = f.k")
    raise ValueError(kind)


PRED_UNION = "\nUNION ALL\n".join(
    _pred_sql(c.name, c.kind, c.features[-1] if c.features else None) for c in CANDIDATES)

_META = ", ".join(f"('{c.name}', {len(c.features)})" for c in CANDIDATES)

PREDS = S.DOC_SPLITS + f""",
train AS (SELECT * FROM doc_splits WHERE data_split = 'train'),
gm AS (SELECT avg(n_chars) AS m FROM train),
preds AS (
{PRED_UNION})"""


def metrics_sql(src: str = "preds", by: str = "model, data_split") -> str:
    return f"""SELECT {by}, CAST(count(*) AS BIGINT) AS rows,
    round(sqrt(sum((actual - predicted) * (actual - predicted)) / count(*)), 6) AS rmse,
    round(avg(abs(actual - predicted)), 6) AS mae,
    round(CASE WHEN var_pop(actual) * count(*) > 0
               THEN 1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(*))
               WHEN sum((actual - predicted) * (actual - predicted)) = 0 THEN 1.0 ELSE 0.0 END, 6) AS r2
  FROM {src} GROUP BY {by}"""


def leaderboard_sql(src: str, name: str, by: str = "") -> str:
    """The leaderboard ``name`` over the predictions ``src``, per ``by``."""
    return f""",
{name}_metrics AS ({metrics_sql(f"(SELECT * FROM {src} WHERE data_split IN ('validation', 'test'))", f"{by}model, data_split")}),
meta AS (SELECT * FROM (VALUES {_META}) AS t(model, feature_count)),
n_train AS (SELECT count(*) AS n FROM train),
{name} AS (
  SELECT {by}m.model,
    max(CASE WHEN data_split = 'validation' THEN rmse END) AS validation_rmse,
    max(CASE WHEN data_split = 'validation' THEN mae END) AS validation_mae,
    max(CASE WHEN data_split = 'validation' THEN r2 END) AS validation_r2,
    max(CASE WHEN data_split = 'test' THEN rmse END) AS test_rmse,
    max(CASE WHEN data_split = 'test' THEN mae END) AS test_mae,
    max(CASE WHEN data_split = 'test' THEN r2 END) AS test_r2,
    any_value(meta.feature_count) AS feature_count,
    CAST(any_value((SELECT n FROM n_train) * (meta.feature_count + 1)) AS BIGINT) AS fit_cells,
    any_value(meta.feature_count) AS predict_cells_per_row
  FROM {name}_metrics m JOIN meta ON m.model = meta.model GROUP BY {by}m.model)"""


LEADERBOARD = PREDS + leaderboard_sql("preds", "leaderboard")

# an experiment per language
EXP_PREDS = PREDS + f""",
exp_preds AS (SELECT '{EXPERIMENT}_' || d.lang AS experiment_id, p.* FROM preds p JOIN doc_splits d ON p.row_id = d.doc_id WHERE d.lang IS NOT NULL)"""
EXP_LEADERBOARD = EXP_PREDS + leaderboard_sql("exp_preds", "exp_leaderboard", "experiment_id, ")

_CORR = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, abs(corr({c}, n_chars)) AS r FROM train" for c in DOC_NUMERIC)

TOP = f""",
corrs AS (SELECT feature, round(r, 6) AS abs_correlation FROM ({_CORR}) WHERE r IS NOT NULL AND NOT isnan(r)),
ranked_corr AS (SELECT *, row_number() OVER (ORDER BY abs_correlation DESC, feature) AS importance_rank FROM corrs),
top AS (SELECT list(feature ORDER BY importance_rank) AS top_features FROM ranked_corr WHERE importance_rank <= {TOP_K})"""

_FEATS = {c.name: list(c.features) for c in CANDIDATES}


def _lst(xs) -> str:
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]::VARCHAR[]"


_MEMBERS = ", ".join(f"('{p}', '{m}', {_lst(_FEATS[m])})" for p, ms in PLATFORMS.items() for m in ms)
_BASE = ", ".join(f"('{m}', {_lst(_FEATS[m])})" for m in BASELINES)

RUNS = LEADERBOARD + TOP + f""",
n_test AS (SELECT count(*) AS n FROM doc_splits WHERE data_split = 'test'),
members AS (SELECT * FROM (VALUES {_MEMBERS}) AS t(platform, model, features)),
sets AS (
  SELECT platform, model, features, 'all_features' AS feature_set, {_lst(ALL_DOC_FEATURES)} AS set_features FROM members
  UNION ALL
  SELECT platform, model, features, 'top_features', (SELECT top_features FROM top) FROM members),
eligible AS (
  SELECT s.*, l.* EXCLUDE (model) FROM sets s JOIN leaderboard l ON s.model = l.model
  WHERE len(list_filter(s.features, lambda x: NOT list_contains(s.set_features, x))) = 0),
searched AS (
  SELECT *, row_number() OVER (PARTITION BY platform, feature_set ORDER BY validation_rmse, model) AS _r,
         sum(fit_cells) OVER (PARTITION BY platform, feature_set) AS training_total
  FROM eligible),
runs AS (
  SELECT '{EXPERIMENT}' AS experiment_id, platform, feature_set, CAST(len(set_features) AS INTEGER) AS feature_count,
         model AS best_model, validation_rmse, test_rmse, test_mae, test_r2,
         CAST(training_total AS DOUBLE) AS training_cells,
         CAST(predict_cells_per_row * (SELECT n FROM n_test) AS DOUBLE) AS prediction_cells,
         true AS is_automl, set_features AS model_features
  FROM searched WHERE _r = 1
  UNION ALL
  SELECT '{EXPERIMENT}', 'baseline', 'all_features', CAST(len(b.features) AS INTEGER), l.model,
         validation_rmse, test_rmse, test_mae, test_r2, CAST(fit_cells AS DOUBLE),
         CAST(predict_cells_per_row * (SELECT n FROM n_test) AS DOUBLE), false, b.features
  FROM (VALUES {_BASE}) AS b(model, features) JOIN leaderboard l ON b.model = l.model)"""
