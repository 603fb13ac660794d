"""Registered queries over many experiments (one per language of the documents):
the closed-form search, blends, trees, registry, trials, measured costs, external
scoring, sketches and artifact checks, each with its SQL twin."""

from __future__ import annotations

import itertools
import uuid

from pyspark.sql import functions as F

from tabready.operators import blend, compare, cost, external, gates, importance, moments, profile, sketches, stump
from tabready.operators.candidates import fit_candidate
from tabready.operators.compare import EXP
from tabready.operators.metrics import regression_metrics
from tabready.plans import model_sql as M
from tabready.plans import models as X
from tabready.plans import sql as S
from tabready.plans.ops_queries import ALL_DOC, IMPORTANCE_MODEL, REPEATS, SQL_PERMUTATION
from tabready.plans.standins import DOC_TARGET, SEED, doc_inputs, doc_splits, table
from tabready.session import ensure_checkpoint_dir, staged
from tabready.sources import io, registry

SPACE = moments.SearchSpace(X.SEARCH_FEATURES, sizes=(1, 2, 3), ridges=X.RIDGES)
SCORES = ["train_rmse", "validation_rmse", "test_rmse", "validation_r2", "test_r2"]


def _folder(spark, kind):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


# ---- L7: closed-form search --------------------------------------------------------

def _search(spark, sf):
    return staged(spark, f"doc_search:{sf}", lambda: moments.search(X.experiment_moments(spark, sf), SPACE), doc_inputs(sf))


def q_closed_form_search(spark, sf):
    """Every set of one to three features with every penalty, fitted and scored
    per experiment from one aggregate."""
    out = moments.rounded(_search(spark, sf))
    return out.select(EXP, "model", "feature_count", "ridge", F.round("intercept", 4).alias("intercept"),
                      F.array_join(F.transform("weights", lambda w: F.round(w, 4).cast("string")), ",").alias("weights"), *SCORES)


def _det(m: list[list[str]]) -> str:
    """The determinant of a matrix of SQL expressions, by its first row."""
    if len(m) == 1:
        return f"({m[0][0]})"
    parts = []
    for j, x in enumerate(m[0]):
        rest = [row[:j] + row[j + 1:] for row in m[1:]]
        parts.append(f"{'-' if j % 2 else '+'} ({x}) * ({_det(rest)})")
    return "(" + " ".join(parts) + ")"


def _search_sql() -> str:
    """Every candidate by Cramer's rule over SQL's own covariances."""
    names = [*X.SEARCH_FEATURES, DOC_TARGET]
    short = dict(zip(names, "abcz"))
    covs = ", ".join(f"covar_pop({p}, {q}) AS {short[p]}{short[q]}" for p, q in itertools.combinations_with_replacement(names, 2))
    means = ", ".join(f"avg({n}) AS m{short[n]}" for n in names)
    cov = lambda p, q: "".join(sorted(short[p] + short[q]))
    fits = []
    for model, chosen, ridge in SPACE.candidates():
        use = [X.SEARCH_FEATURES[i] for i in chosen]
        # the penalty stands on features scaled to unit variance
        left = [[f"{cov(p, q)} * {1 + ridge}" if p == q else cov(p, q) for q in use] for p in use]
        weights = []
        for k in range(len(use)):
            swapped = [[cov(p, DOC_TARGET) if j == k else x for j, x in enumerate(row)] for p, row in zip(use, left)]
            weights.append(f"{_det(swapped)} / {_det(left)}")
        every = ", ".join(f"{weights[use.index(f)] if f in use else 'CAST(0 AS DOUBLE)'} AS w{short[f]}" for f in X.SEARCH_FEATURES)
        shown = " || ',' || ".join(f"CAST(round(w{short[f]}, 4) AS VARCHAR)" for f in use)
        fits.append(f"SELECT experiment_id, '{model}' AS model, {len(use)} AS feature_count, CAST({ridge} AS DOUBLE) AS ridge, {every}, "
                    f"$shown{len(fits)}$ AS k FROM m WHERE data_split = 'train'".replace(f"$shown{len(fits)}$", f"{len(fits)}"))
        fits[-1] = (fits[-1], shown)
    union = "\nUNION ALL ".join(f for f, _ in fits)
    shown = "CASE k " + " ".join(f"WHEN {k} THEN {s}" for k, (_, s) in enumerate(fits)) + " END"
    lin = " - ".join(f"w{s} * s.m{s}" for s in "abc")
    spread = "s.zz" + "".join(f" - 2 * w{s} * s.{s}z" for s in "abc") + "".join(
        f" + {1 if p == q else 2} * w{p} * w{q} * s.{p}{q}" for p, q in itertools.combinations_with_replacement("abc", 2))
    return S.with_(S.DOC_SPLITS) + f""",
d AS (SELECT *, word_count / line_count AS words_per_line, '{X.EXPERIMENT}_' || lang AS experiment_id FROM doc_splits WHERE lang IS NOT NULL),
m AS (SELECT experiment_id, data_split, {means}, {covs} FROM d GROUP BY ALL),
fits AS ({union}),
full_fits AS (SELECT f.*, t.mz - wa * t.ma - wb * t.mb - wc * t.mc AS intercept, {shown} AS weights FROM fits f JOIN m t
  ON t.experiment_id = f.experiment_id AND t.data_split = 'train'),
e AS (SELECT f.experiment_id, f.model, s.data_split, greatest(0, {spread}) + (s.mz - f.intercept - {lin}) * (s.mz - f.intercept - {lin}) AS mse, s.zz
  FROM full_fits f JOIN m s ON s.experiment_id = f.experiment_id)
SELECT f.experiment_id, f.model, f.feature_count, f.ridge, round(f.intercept, 4) AS intercept, f.weights,
  {", ".join(f"round(max(CASE WHEN e.data_split = '{s}' THEN sqrt(e.mse) END), 6) AS {s}_rmse" for s in moments.SPLITS)},
  {", ".join(f"round(max(CASE WHEN e.data_split = '{s}' THEN 1 - e.mse / e.zz END), 6) AS {s}_r2" for s in ("validation", "test"))}
FROM full_fits f JOIN e ON e.experiment_id = f.experiment_id AND e.model = f.model GROUP BY ALL"""


def _docs(spark, sf):
    return X.with_search_features(doc_splits(spark, sf)).filter("lang IS NOT NULL").withColumn(EXP, F.concat(F.lit(f"{X.EXPERIMENT}_"), "lang"))


def q_search_predictions(spark, sf):
    """L7 + A12: the three best candidates of each experiment predict, all in one
    pass; their errors from predictions equal those from the moments."""
    from tabready.operators.leaderboard import top_models_by_score

    best = top_models_by_score(moments.rounded(_search(spark, sf)), 3, by=[EXP]).select(
        EXP, "model", "features", "intercept", "weights", F.col("validation_rmse").alias("searched_rmse"))
    preds = moments.predict_candidates(_docs(spark, sf), best, "doc_id", DOC_TARGET, EXP)
    got = regression_metrics(preds.filter("data_split = 'validation'"), [EXP, "model"], digits=4)
    return got.join(best, [EXP, "model"]).select(EXP, "model", "rows", "rmse", "mae", "r2", (F.abs(F.col("rmse") - F.col("searched_rmse")) < 1e-3).alias("agrees"))


# the three best of each experiment by the search above, predicted row by row
SQL_SEARCH_PREDICTIONS = _search_sql().rsplit("SELECT f.experiment_id", 1)[0] + f""",
ranked AS (SELECT *, row_number() OVER (PARTITION BY experiment_id ORDER BY round(sqrt(mse), 6), model) AS r FROM e WHERE data_split = 'validation'),
p AS (SELECT f.experiment_id, f.model, d.{DOC_TARGET} AS actual, f.intercept + wa * word_count + wb * line_count + wc * words_per_line AS predicted
  FROM d JOIN full_fits f ON d.experiment_id = f.experiment_id JOIN ranked k ON k.experiment_id = f.experiment_id AND k.model = f.model
  WHERE k.r <= 3 AND d.data_split = 'validation')
SELECT experiment_id, model, CAST(count(*) AS BIGINT) AS rows, round(sqrt(avg((actual - predicted) ** 2)), 4) AS rmse,
  round(avg(abs(actual - predicted)), 4) AS mae, round(1 - sum((actual - predicted) ** 2) / (var_pop(actual) * count(*)), 4) AS r2, true AS agrees
FROM p GROUP BY ALL"""


# ---- L13 on closed-form candidates --------------------------------------------------

def q_closed_form_rerun(spark, sf):
    """L13 + J4: each experiment's search run again on its two features of most
    correlation, compared with the search over all of them."""
    found = _search(spark, sf)
    corr = moments.feature_correlations(X.experiment_moments(spark, sf).filter("data_split = 'train'"), X.SEARCH_FEATURES)
    from tabready.operators.leaderboard import top_features
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy(EXP).orderBy(F.desc(F.round(F.abs("correlation"), 6)), "feature"))
    top = top_features(corr.withColumn("importance_rank", rank), X.TOP_K, by=[EXP])
    sets = found.join(top, EXP).select("*", F.explode(F.array(
        F.struct(F.lit(compare.ALL_FEATURES).alias("feature_set"), F.lit(len(X.SEARCH_FEATURES)).alias("n")),
        F.struct(F.lit(compare.TOP_FEATURES).alias("feature_set"), F.lit(X.TOP_K).alias("n")))).alias("_s"))
    inside = (F.col("_s.feature_set") == compare.ALL_FEATURES) | (F.size(F.array_except("features", "top_features")) == 0)
    best = F.row_number().over(Window.partitionBy(EXP, "_s.feature_set").orderBy(F.round("validation_rmse", 6), "model"))
    rows = sets.filter(inside).withColumn("_r", best).filter("_r = 1")
    cells = F.count(F.lit(1)).over(Window.partitionBy(EXP, "_s.feature_set"))
    tried = sets.filter(inside).withColumn("_tried", cells).select(EXP, F.col("_s.feature_set").alias("feature_set"), "_tried").distinct()
    runs = rows.withColumn("feature_set", F.col("_s.feature_set")).join(tried, [EXP, "feature_set"]).select(
        EXP, F.lit("closed_form").alias("platform"), "feature_set", F.col("_s.n").alias("feature_count"), F.col("model").alias("best_model"),
        *[F.round(c, 6).alias(c) for c in ("validation_rmse", "test_rmse", "test_r2")], F.lit(0.0).alias("test_mae"),
        F.col("_tried").cast("double").alias("candidates"), F.col("feature_count").cast("double").alias("terms"), F.lit(True).alias("is_automl"))
    out = compare.compare_feature_sets(runs, ("candidates", "terms"))
    return out.select(EXP, "all_features_best_model", "top_features_best_model", "all_features_count", "top_features_count",
                      *[F.round(f"{c}_delta_top_minus_all", 5).alias(f"{c}_delta") for c in ("validation_rmse", "test_rmse", "test_r2", "candidates", "terms")],
                      "validation_performance_assessment")


_IMP = " UNION ALL ".join(f"SELECT experiment_id, '{c}' AS feature, round(abs(corr({c}, {DOC_TARGET})), 6) AS r FROM d WHERE data_split = 'train' GROUP BY 1"
                          for c in X.SEARCH_FEATURES)
SQL_RERUN = _search_sql().rsplit("SELECT f.experiment_id", 1)[0] + f""",
imp AS (SELECT *, row_number() OVER (PARTITION BY experiment_id ORDER BY r DESC, feature) AS k FROM ({_IMP})),
tops AS (SELECT experiment_id, list(feature) AS tops FROM imp WHERE k <= {X.TOP_K} GROUP BY 1),
found AS (SELECT experiment_id, model, max(CASE WHEN data_split = 'validation' THEN round(sqrt(mse), 6) END) AS v,
  max(CASE WHEN data_split = 'test' THEN round(sqrt(mse), 6) END) AS t, max(CASE WHEN data_split = 'test' THEN round(1 - mse / zz, 6) END) AS r2,
  string_split(string_split(model, ':')[2], '+') AS features FROM e GROUP BY experiment_id, model),
sets AS (SELECT f.*, 'all' AS s FROM found f UNION ALL
  SELECT f.*, 'top' FROM found f JOIN tops USING (experiment_id) WHERE len(list_filter(f.features, lambda x: NOT list_contains(tops, x))) = 0),
best AS (SELECT *, row_number() OVER (PARTITION BY experiment_id, s ORDER BY v, model) AS k, count(*) OVER (PARTITION BY experiment_id, s) AS tried FROM sets)
SELECT a.experiment_id, a.model AS all_features_best_model, b.model AS top_features_best_model, {len(X.SEARCH_FEATURES)} AS all_features_count,
  {X.TOP_K} AS top_features_count, round(b.v - a.v, 5) AS validation_rmse_delta, round(b.t - a.t, 5) AS test_rmse_delta,
  round(b.r2 - a.r2, 5) AS test_r2_delta, CAST(b.tried - a.tried AS DOUBLE) AS candidates_delta,
  CAST(len(b.features) - len(a.features) AS DOUBLE) AS terms_delta,
  CASE WHEN b.v < a.v THEN 'improved' WHEN b.v > a.v THEN 'degraded' ELSE 'maintained' END AS validation_performance_assessment
FROM best a JOIN best b ON a.experiment_id = b.experiment_id AND a.s = 'all' AND b.s = 'top' AND a.k = 1 AND b.k = 1"""


# ---- L8: blends per experiment -------------------------------------------------------

BLEND_ROUNDS = 12
MODELS = [c.name for c in X.CANDIDATES]


def _weights(spark, sf):
    matrices = blend.error_matrices(X.experiment_predictions(spark, sf), MODELS)
    return staged(spark, f"doc_blend:{sf}", lambda: blend.blend_weights(matrices, BLEND_ROUNDS), doc_inputs(sf))


def q_blend_weights(spark, sf):
    """Greedy weights of every experiment, by a fold over its error matrix."""
    return _weights(spark, sf).select(EXP, "model", F.round("weight", 6).alias("weight"))


_K = len(MODELS)
_LIST = "[" + ", ".join(f"'{m}'" for m in MODELS) + "]"
_COUNTS = ("list_transform(s.counts, lambda n, i: n + CASE WHEN i = list_position(s.scores, list_min(s.scores)) THEN 1 ELSE 0 END)")
_BLEND = S.with_(M.EXP_PREDS).replace("WITH ", "WITH RECURSIVE ", 1) + f""",
err AS (SELECT experiment_id, row_id, model, actual - predicted AS e FROM exp_preds WHERE data_split = 'validation'),
gram AS (SELECT a.experiment_id, list_position({_LIST}, a.model) AS i, list_position({_LIST}, b.model) AS j, avg(a.e * b.e) AS g
  FROM err a JOIN err b USING (experiment_id, row_id) GROUP BY ALL),
rows_of AS (SELECT experiment_id, i, list(g ORDER BY j) AS row FROM gram GROUP BY ALL),
mats AS (SELECT experiment_id, list(row ORDER BY i) AS g, max(row[i]) AS scale FROM rows_of GROUP BY ALL),
steps AS (
  SELECT experiment_id, 0 AS n, list_transform(range({_K}), lambda x: 0) AS counts FROM mats
  UNION ALL
  SELECT s.experiment_id, s.n + 1, {_COUNTS} FROM (
    SELECT p.experiment_id, p.n, p.counts, list_transform(m.g, lambda row, i: round((2 * list_sum(list_transform(row, lambda x, j: x * p.counts[j])) + row[i])
      / m.scale, {blend.SCORE_DIGITS})) AS scores
    FROM steps p JOIN mats m USING (experiment_id) WHERE p.n < {BLEND_ROUNDS}) s),
weights AS (SELECT experiment_id, {_LIST}[k] AS model, counts[k] / CAST({BLEND_ROUNDS} AS DOUBLE) AS weight
  FROM steps, range(1, {_K + 1}) t(k) WHERE n = {BLEND_ROUNDS} AND counts[k] > 0)"""
SQL_BLEND = _BLEND + "\nSELECT experiment_id, model, round(weight, 6) AS weight FROM weights"


def q_blend_leaderboard(spark, sf):
    """L8 + H12: the blend among its base models, with marginal and total cost."""
    preds, weights = X.experiment_predictions(spark, sf), _weights(spark, sf)
    every = preds.select(EXP, "model", "row_id", "data_split", "actual", "predicted").unionByName(blend.blended(preds, weights))
    scores = regression_metrics(every.filter("data_split IN ('validation', 'test')"), [EXP, "model", "data_split"], digits=4)
    wide = scores.groupBy(EXP, "model").agg(*[F.max(F.when(F.col("data_split") == s, F.col("rmse"))).alias(f"{s}_rmse") for s in ("validation", "test")])
    base = X.experiment_leaderboard(spark, sf).select(EXP, "model", "fit_cells")
    # what choosing the weights read: every model's error on every validation row
    chosen = preds.filter("data_split = 'validation'").groupBy(EXP).agg(F.count(F.lit(1)).alias("fit_cells"))
    costs = blend.blend_costs(weights, base, "fit_cells", chosen)
    return wide.join(costs, [EXP, "model"])


SQL_BLEND_LB = _BLEND.replace("WITH RECURSIVE", "WITH RECURSIVE", 1) + M.leaderboard_sql("exp_preds", "exp_leaderboard", "experiment_id, ") + f""",
mixed AS (SELECT p.experiment_id, p.row_id, p.data_split, max(actual) AS actual, sum(weight * predicted) AS predicted
  FROM exp_preds p JOIN weights w ON p.experiment_id = w.experiment_id AND p.model = w.model GROUP BY ALL),
every AS (SELECT experiment_id, model, data_split, actual, predicted FROM exp_preds UNION ALL
  SELECT experiment_id, '{blend.BLEND}', data_split, actual, predicted FROM mixed),
scored AS (SELECT experiment_id, model,
  round(sqrt(avg(CASE WHEN data_split = 'validation' THEN (actual - predicted) ** 2 END)), 4) AS validation_rmse,
  round(sqrt(avg(CASE WHEN data_split = 'test' THEN (actual - predicted) ** 2 END)), 4) AS test_rmse FROM every GROUP BY ALL),
base AS (SELECT experiment_id, model, fit_cells AS fit_cells_marginal, fit_cells AS fit_cells_total FROM exp_leaderboard),
own AS (SELECT experiment_id, count(*) AS n FROM err GROUP BY 1),
held AS (SELECT w.experiment_id, sum(fit_cells) AS c FROM weights w JOIN exp_leaderboard b ON w.experiment_id = b.experiment_id AND w.model = b.model GROUP BY 1),
costs AS (SELECT * FROM base UNION ALL SELECT experiment_id, '{blend.BLEND}', n, n + c FROM own JOIN held USING (experiment_id))
SELECT s.experiment_id, s.model, validation_rmse, test_rmse, CAST(fit_cells_marginal AS BIGINT) AS fit_cells_marginal,
  CAST(fit_cells_total AS BIGINT) AS fit_cells_total FROM scored s JOIN costs c ON s.experiment_id = c.experiment_id AND s.model = c.model"""


# ---- L11: a tree that SQL can check ---------------------------------------------------

BINS = 16


def _cuts(spark, sf):
    ensure_checkpoint_dir(spark)
    train = _docs(spark, sf).filter("data_split = 'train'")
    return stump.best_cuts(stump.feature_cells(train, X.SEARCH_FEATURES, DOC_TARGET, EXP, BINS))


def q_stump_splits(spark, sf):
    """The best cut of every feature and experiment, from histogram aggregates."""
    return _cuts(spark, sf).select(EXP, "feature", "cut_cell", F.round("gain", 0).alias("gain"), F.round("left_mean", 4).alias("left_mean"),
                                   F.round("right_mean", 4).alias("right_mean"))


_CELLS = S.with_(S.DOC_SPLITS) + f""",
d AS (SELECT *, word_count / line_count AS words_per_line, '{X.EXPERIMENT}_' || lang AS experiment_id FROM doc_splits
  WHERE lang IS NOT NULL AND data_split = 'train'),
long AS ({" UNION ALL ".join(f"SELECT experiment_id, '{c}' AS feature, {c} AS x, {DOC_TARGET} AS y, min({c}) OVER (PARTITION BY experiment_id) AS lo, max({c}) OVER (PARTITION BY experiment_id) AS hi FROM d" for c in X.SEARCH_FEATURES)}),
cells AS (SELECT experiment_id, feature, CAST(CASE WHEN hi > lo THEN least(floor((x - lo) / (hi - lo) * {BINS}), {BINS - 1}) ELSE 0 END AS INTEGER) AS cell,
  count(*) AS n, sum(y) AS s FROM long GROUP BY ALL),
run AS (SELECT experiment_id, feature, cell, sum(n) OVER w AS n1, sum(s) OVER w AS s1, sum(n) OVER p AS n, sum(s) OVER p AS s FROM cells
  WINDOW w AS (PARTITION BY experiment_id, feature ORDER BY cell), p AS (PARTITION BY experiment_id, feature)),
gains AS (SELECT experiment_id, feature, cell, round(n1 * (n - n1) / n * (s1 / n1 - (s - s1) / (n - n1)) * (s1 / n1 - (s - s1) / (n - n1)), 4) AS gain,
  s1 / n1 AS left_mean, (s - s1) / (n - n1) AS right_mean FROM run WHERE n > n1),
best AS (SELECT *, row_number() OVER (PARTITION BY experiment_id, feature ORDER BY gain DESC, cell) AS r FROM gains)"""
SQL_STUMP = _CELLS + """
SELECT experiment_id, feature, cell AS cut_cell, round(gain, 0) AS gain, round(left_mean, 4) AS left_mean, round(right_mean, 4) AS right_mean
FROM best WHERE r = 1"""


def q_tree_importance(spark, sf):
    """Importances of the best-ranked model that has them; the closed-form
    candidates have none, so the tree's own are found behind them."""
    imp = stump.stump_importance(_cuts(spark, sf), X.SEARCH_FEATURES)
    board = X.experiment_leaderboard(spark, sf).select(EXP, "model", "validation_rmse")
    # the tree takes a place between the third and the fourth model
    tree = board.groupBy(EXP).agg(F.array_sort(F.collect_list("validation_rmse")).alias("_v")).select(
        EXP, F.lit("tree").alias("model"), ((F.col("_v")[2] + F.col("_v")[3]) / 2).alias("validation_rmse"))
    out = stump.best_model_importance(board.unionByName(tree), [stump.RankedModel(m) for m in MODELS] + [stump.RankedModel("tree", imp)])
    return out.withColumn("relative_importance", F.round("relative_importance", 0))


SQL_TREE_IMPORTANCE = _CELLS + f""", f AS (SELECT unnest([{", ".join(f"'{c}'" for c in X.SEARCH_FEATURES)}]) AS variable)
SELECT x.experiment_id, 'tree' AS model, variable, round(coalesce(gain, 0), 0) AS relative_importance
FROM (SELECT DISTINCT experiment_id, variable FROM d, f) x LEFT JOIN (SELECT * FROM best WHERE r = 1) b
  ON b.experiment_id = x.experiment_id AND b.feature = x.variable"""


# ---- L10: statistics of permutation importance -----------------------------------------

def q_importance_statistics(spark, sf):
    """Importance with p-value, n and the 99 % interval."""
    splits = doc_splits(spark, sf)
    cand = next(c for c in X.CANDIDATES if c.name == IMPORTANCE_MODEL)
    scorer = fit_candidate(splits.filter(F.col("data_split") == "train"), cand, DOC_TARGET)
    per = importance.repeat_importance(splits.filter(F.col("data_split") == "validation"), scorer, ALL_DOC, DOC_TARGET, "doc_id", REPEATS, SEED)
    return importance.importance_statistics(per).withColumns(
        {c: F.round(c, 4) for c in ("importance", "stddev", "p_value", "p99_low", "p99_high")})


# with two degrees of freedom the distribution and its quantile have a closed form
_T2 = "0.99 * sqrt(2 / (4 * 0.995 * 0.005))"
SQL_IMPORTANCE_STATISTICS = SQL_PERMUTATION.rsplit("\nSELECT _feature AS feature", 1)[0] + f""",
settled AS (SELECT _feature, round(v, 9) AS v FROM imp),
st AS (SELECT _feature AS feature, avg(v) AS m, stddev_samp(v) AS sd, count(*) AS n, avg(v) / (stddev_samp(v) / sqrt(count(*))) AS t FROM settled GROUP BY 1)
SELECT feature, round(m, 4) AS importance, round(sd, 4) AS stddev,
  round(CASE WHEN sd = 0 THEN CASE WHEN m > 0 THEN 0.0 WHEN m < 0 THEN 1.0 ELSE 0.5 END ELSE 0.5 - t / (2 * sqrt(2 + t * t)) END, 4) AS p_value,
  CAST(n AS BIGINT) AS n, round(m - {_T2} * sd / sqrt(n), 4) AS p99_low, round(m + {_T2} * sd / sqrt(n), 4) AS p99_high FROM st"""


# ---- S9, S4, L17: registry ---------------------------------------------------------------

RUN_ID = "concat_ws('/', experiment_id, platform, feature_set, best_model)"


def _registered(spark, sf):
    """Two recordings of every run: a draft with scores that were wrong and a
    note, then the final scores, another stage, and the note taken away."""
    path = _folder(spark, "registry")
    runs = X.runs_table(spark, sf).withColumns({
        "package_versions": F.create_map(F.lit("engine"), F.lit("4.1"), F.lit("library"), F.lit("1.0")),
        "search_space": F.create_map(F.lit("features"), F.size("model_features"), F.lit("top_k"), F.lit(X.TOP_K)),
        "stage": F.lit("final"), "note": F.lit(None).cast("string"), "run_id": F.expr(RUN_ID)})
    draft = runs.withColumns({"test_rmse": F.lit(-1.0), "stage": F.lit("draft"), "note": F.lit("it's a \"draft\"")})
    params, kinds = ["platform", "feature_count", "model_features", "is_automl"], {"version": ["package_versions"], "config": ["search_space"]}
    registry.append_entries(registry.run_entries(draft, "run_id", 1, param=params, metric=["validation_rmse", "test_rmse"], tag=["stage", "note"], **kinds), path)
    registry.append_entries(registry.run_entries(runs, "run_id", 2, metric=["test_rmse", "test_r2", "training_cells"], tag=["stage", "note"]), path)
    return path


def q_registry_pivot(spark, sf):
    """S9 + S4: two versions of every run appended in long form; the pivot has the
    last value of each key, in its type."""
    entries = registry.read_entries(spark, _registered(spark, sf))
    wide = registry.pivot_runs(entries, {
        "platform": ("param", "platform", "string"), "feature_count": ("param", "feature_count", "int"),
        "model_features": ("param", "model_features", "array<string>"), "is_automl": ("param", "is_automl", "boolean"),
        "validation_rmse": ("metric", "validation_rmse", "double"), "test_rmse": ("metric", "test_rmse", "double"),
        "test_r2": ("metric", "test_r2", "double"), "stage": ("tag", "stage", "string"), "note": ("tag", "note", "string"),
        "engine": ("version", "engine", "string"), "top_k": ("config", "top_k", "int"), "never": ("param", "never", "string")})
    return wide.withColumn("model_features", F.array_join("model_features", ",")).withColumns(
        {c: F.round(c, 6) for c in ("validation_rmse", "test_rmse", "test_r2")})


SQL_REGISTRY_PIVOT = S.with_(M.RUNS) + f"""SELECT {RUN_ID} AS run_id, platform, feature_count, array_to_string(model_features, ',') AS model_features, is_automl,
  round(validation_rmse, 6) AS validation_rmse, round(test_rmse, 6) AS test_rmse, round(test_r2, 6) AS test_r2, 'final' AS stage,
  CAST(NULL AS VARCHAR) AS note, '4.1' AS engine, {X.TOP_K} AS top_k, CAST(NULL AS VARCHAR) AS never FROM runs"""


def q_registry_entries(spark, sf):
    """The registry's last entries by kind and key, after compaction."""
    path = registry.compact_entries(spark, _registered(spark, sf), _folder(spark, "registry-compact"))
    return registry.read_entries(spark, path).groupBy("kind", "key", "value_type").agg(
        F.count(F.lit(1)).alias("runs"), F.min("recorded").alias("least_recorded"), F.max("recorded").alias("most_recorded"))


SQL_REGISTRY_ENTRIES = S.with_(M.RUNS) + """SELECT kind, key, value_type, (SELECT count(*) FROM runs) AS runs, rec AS least_recorded, rec AS most_recorded FROM (VALUES
  ('param', 'platform', 'string', 1::BIGINT), ('param', 'feature_count', 'int', 1), ('param', 'model_features', 'array<string>', 1), ('param', 'is_automl', 'boolean', 1),
  ('metric', 'validation_rmse', 'double', 1), ('metric', 'test_rmse', 'double', 2), ('metric', 'test_r2', 'double', 2), ('metric', 'training_cells', 'double', 2),
  ('tag', 'stage', 'string', 2), ('version', 'engine', 'string', 1), ('version', 'library', 'string', 1), ('config', 'features', 'int', 1),
  ('config', 'top_k', 'int', 1)) AS t(kind, key, value_type, rec)"""


def q_registry_trials(spark, sf):
    """L17 over the registry: params and metrics as JSON and back by a schema each."""
    found = _search(spark, sf).withColumns({
        "run_id": F.concat_ws("/", EXP, "model"), "validation_rmse": F.round("validation_rmse", 4), "test_rmse": F.round("test_rmse", 4),
        "cells": (F.col("feature_count") + 1).cast("double")})
    path = _folder(spark, "trials")
    registry.append_entries(registry.run_entries(found, "run_id", 7, param=["model", "ridge", "feature_count", "features"],
                                                 metric=["validation_rmse", "test_rmse", "cells"]), path)
    trials = registry.trial_rows(registry.read_entries(spark, path, ["param", "metric"]), "validation_rmse", "cells")
    out = registry.typed_trials(trials, "model string, ridge double, feature_count int", "test_rmse double, cells double")
    keys = F.array_join(F.json_object_keys("params_json"), ",")
    return out.join(trials.select("run_id", keys.alias("param_keys")), "run_id")


SQL_TRIALS = _search_sql().rsplit("SELECT f.experiment_id", 1)[0] + """
SELECT f.experiment_id || '/' || f.model AS run_id, max(CASE WHEN data_split = 'validation' THEN round(sqrt(mse), 4) END) AS score,
  CAST(f.feature_count + 1 AS DOUBLE) AS duration, CAST(7 AS BIGINT) AS last_recorded, f.model, f.ridge, f.feature_count,
  max(CASE WHEN data_split = 'test' THEN round(sqrt(mse), 4) END) AS test_rmse, CAST(f.feature_count + 1 AS DOUBLE) AS cells,
  'feature_count,features,model,ridge' AS param_keys
FROM full_fits f JOIN e ON e.experiment_id = f.experiment_id AND e.model = f.model GROUP BY ALL"""


# ---- A13, L12: measured costs --------------------------------------------------------------

def q_measured_costs(spark, sf):
    """A13 + L12: rows and cells of every fit and prediction pass, counted by the
    pass itself, and whether its seconds were taken."""
    docs = doc_splits(spark, sf)
    fits = {c.name: (c.features, lambda df, c=c: fit_candidate(df, c, DOC_TARGET)) for c in X.CANDIDATES if c.kind in ("group_mean", "group_ols")}
    costs = cost.measured_costs(spark, docs.filter("data_split = 'train'"), docs.filter("data_split = 'test'"), DOC_TARGET, fits)
    wide = cost.cost_columns(costs)
    return wide.select("model", "fit_rows", "fit_cells", "predict_rows", F.round("predict_cells_per_row", 6).alias("predict_cells_per_row"),
                       (F.col("fit_seconds") > 0).alias("fit_timed"), (F.col("predict_seconds_per_row") > 0).alias("predictions_timed"))


_COSTED = ", ".join(f"('{c.name}', [{', '.join(repr(f) for f in c.features)}])" for c in X.CANDIDATES if c.kind in ("group_mean", "group_ols"))


def _cells(features: str, split: str) -> str:
    return " + ".join(f"CASE WHEN list_contains({features}, '{f}') THEN (SELECT count({f}) FROM doc_splits WHERE data_split = '{split}') ELSE 0 END"
                      for f in ("word_count", "line_count", "lang", "source"))


SQL_COSTS = S.with_(S.DOC_SPLITS) + f"""SELECT model, n AS fit_rows, CAST(y + {_cells('features', 'train')} AS BIGINT) AS fit_cells, t AS predict_rows,
  round(({_cells('features', 'test')}) / CAST(t AS DOUBLE), 6) AS predict_cells_per_row, true AS fit_timed, true AS predictions_timed
FROM (VALUES {_COSTED}) AS c(model, features), (SELECT count(*) FILTER (data_split = 'train') AS n, count({DOC_TARGET}) FILTER (data_split = 'train') AS y,
  count(*) FILTER (data_split = 'test') AS t FROM doc_splits)"""


# ---- external models -------------------------------------------------------------------------

def q_external_scores(spark, sf):
    """Predictions of a model from outside Spark: the line that least squares give
    on the train rows, handed over as a plain object."""
    from tabready.plans.sink_queries import _line_model

    line = _line_model(spark, sf).stages[-1]
    scorer = external.LinearScorer(line.intercept, line.coefficients.toArray())
    out = external.score_external(doc_splits(spark, sf).filter("data_split = 'test'"), scorer, ["word_count"], ["doc_id"], batch_rows=100)
    return out.select("doc_id", F.round("predicted", 4).alias("predicted"))


# ---- A1, A9: sketches ---------------------------------------------------------------------------

SKETCHED = ("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate")


def q_sketched_profile(spark, sf):
    """A1: distinct counts united from the sketches that are stored per data file,
    with the exact counts and a bound that holds."""
    lines = table(spark, sf, "lineitem")
    path = _folder(spark, "sketches")
    sketches.file_sketches(lines, SKETCHED).write.parquet(path)
    exact = lines.agg(*[F.count_distinct(c).alias(c) for c in SKETCHED]).select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("unique_count")) for c in SKETCHED])).alias("_c")).select("_c.*")
    out = sketches.check_estimates(sketches.approximate_profile(spark.read.parquet(path)), exact)
    return out.select("column", "rows", "missing", "unique_count", "within_bound", F.round("bound", 6).alias("bound"))


def _sketch_sql() -> str:
    bound = sketches.relative_bound()
    return "\nUNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS missing, count(DISTINCT {c}) AS unique_count,
  true AS within_bound, round({bound!r} * count(DISTINCT {c}), 6) AS bound FROM lineitem""" for c in SKETCHED)


# ---- Q1 "exists" ---------------------------------------------------------------------------------

def q_artifact_checks(spark, sf):
    """Q1 kind "exists": files, folders and catalog tables that a run should have
    left: present, absent and empty ones."""
    base, name = _folder(spark, "artifacts"), f"metrics_{uuid.uuid4().hex}"
    X.leaderboard(spark, sf).write.parquet(f"{base}/reports/leaderboard")
    spark.createDataFrame([], "note string").coalesce(1).write.text(f"{base}/reports/notes")
    io.save_results_as_tables({name: X.leaderboard(spark, sf).select("model", "validation_rmse")})
    listing = gates.artifact_listing(spark, base, [name, "no_such_table"])
    expected = spark.createDataFrame([("reports/leaderboard", "file"), ("reports/notes/", "file"), ("reports/leaderboard/_SUCCESS", "file"),
                                      ("model", "file"), (name, "table"), ("no_such_table", "table")], "artifact string, kind string")
    out = gates.check_exists(expected, listing)
    return out.withColumn("table_name", F.when(F.col("table_name") == name, "metrics").otherwise(F.col("table_name")))


SQL_ARTIFACTS = """SELECT * FROM (VALUES ('reports/leaderboard', 'file exists', 'PASS', 'present'), ('reports/notes', 'file exists', 'WARN', 'empty'),
  ('reports/leaderboard/_SUCCESS', 'file exists', 'WARN', 'empty'), ('model', 'file exists', 'FAIL', 'absent'),
  ('metrics', 'table exists', 'PASS', 'present'), ('no_such_table', 'table exists', 'FAIL', 'absent')) AS t(table_name, check_name, status, details)"""


# ---- L6: a bound that SQL can check -----------------------------------------------------------------

def q_forest_beats_mean(spark, sf):
    """The forest's test error against the train mean's, per split."""
    from tabready.plans import ml_queries

    forest = ml_queries.q_random_forest_baseline(spark, sf).select("data_split", "rows", F.col("rmse").alias("forest_rmse"))
    mean = regression_metrics(X.predictions(spark, sf).filter("model = 'mean'"), ["data_split"]).select("data_split", F.col("rmse").alias("mean_rmse"))
    return forest.join(mean, "data_split").select("data_split", "rows", F.round("mean_rmse", 4).alias("mean_rmse"),
                                                  (F.col("forest_rmse") < F.col("mean_rmse")).alias("forest_is_better"))


SQL_FOREST = S.with_(M.PREDS) + """SELECT data_split, count(*) AS rows, round(sqrt(avg((actual - predicted) ** 2)), 4) AS mean_rmse, true AS forest_is_better
FROM preds WHERE model = 'mean' GROUP BY 1"""


def _line_sql() -> str:
    from tabready.plans.sink_queries import SQL_MODEL

    return SQL_MODEL


QUERIES = {
    "closed_form_search": (q_closed_form_search, _search_sql()),
    "search_predictions": (q_search_predictions, SQL_SEARCH_PREDICTIONS),
    "closed_form_rerun": (q_closed_form_rerun, SQL_RERUN),
    "blend_weights": (q_blend_weights, SQL_BLEND),
    "blend_leaderboard": (q_blend_leaderboard, SQL_BLEND_LB),
    "stump_splits": (q_stump_splits, SQL_STUMP),
    "tree_importance": (q_tree_importance, SQL_TREE_IMPORTANCE),
    "importance_statistics": (q_importance_statistics, SQL_IMPORTANCE_STATISTICS),
    "registry_pivot": (q_registry_pivot, SQL_REGISTRY_PIVOT),
    "registry_entries": (q_registry_entries, SQL_REGISTRY_ENTRIES),
    "registry_trials": (q_registry_trials, SQL_TRIALS),
    "measured_costs": (q_measured_costs, SQL_COSTS),
    "external_scores": (q_external_scores, _line_sql()),
    "sketched_profile": (q_sketched_profile, _sketch_sql()),
    "artifact_checks": (q_artifact_checks, SQL_ARTIFACTS),
    "forest_beats_mean": (q_forest_beats_mean, SQL_FOREST),
}
