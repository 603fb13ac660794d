"""Closed-form search, blends, trees, importance statistics, measured costs,
external models, sketches and artifact checks."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tabready.functions.distributions import incomplete_beta, log_gamma, student_t_quantile, student_t_tail
from tabready.operators import blend, cost, external, gates, moments, sketches, stump
from tabready.operators.importance import importance_statistics

# ---- Student's t ----

# Upper 0.5 % and 5 % points of Student's t, from tables.
POINTS = [(1, 0.005, 63.6567411629), (2, 0.005, 9.9248432009), (3, 0.005, 5.8409093097), (4, 0.005, 4.6040948714), (10, 0.005, 3.1692726726),
          (30, 0.005, 2.7499956536), (1000, 0.005, 2.5807546981), (5, 0.05, 2.0150483733), (12, 0.05, 1.7822875556)]


def test_student_t_against_tables(spark):
    df = spark.createDataFrame(POINTS, "df int, p double, t double")
    got = df.select("p", "t", student_t_quantile(F.col("p"), F.col("df")).alias("q"), student_t_tail(F.col("t"), F.col("df")).alias("tail"),
                    student_t_tail(-F.col("t"), F.col("df")).alias("left"), student_t_quantile(1 - F.col("p"), F.col("df")).alias("minus"))
    for r in got.collect():
        assert r.q == pytest.approx(r.t, rel=1e-9) and r.tail == pytest.approx(r.p, rel=1e-8)
        assert r.left == pytest.approx(1 - r.p, rel=1e-9) and r.minus == pytest.approx(-r.t, rel=1e-9)


def test_student_t_ends(spark):
    rows = [(float("inf"), 3, 0.0), (float("-inf"), 3, 1.0), (0.0, 3, 0.5), (float("nan"), 3, None), (None, 3, None), (1.0, 0, None), (1.0, None, None)]
    df = spark.createDataFrame(rows, "t double, df int, want double")
    assert [r.got for r in df.select(student_t_tail(F.col("t"), F.col("df")).alias("got")).collect()] == [r[2] for r in rows]
    edge = spark.range(1).select(student_t_quantile(F.lit(0.5), F.lit(4)).alias("m"), student_t_quantile(F.lit(0.0), F.lit(4)).alias("z"))
    assert tuple(edge.first()) == (0.0, None)


def test_beta_and_gamma(spark):
    row = spark.range(1).select(*[log_gamma(F.lit(x)).alias(f"g{i}") for i, x in enumerate((0.5, 1.0, 5.5, 100.0))],
                                *[incomplete_beta(F.lit(x), F.lit(2.0), F.lit(3.0)).alias(f"b{i}") for i, x in enumerate((0.0, 0.2, 0.5, 0.9, 1.0))]).first()
    for i, x in enumerate((0.5, 1.0, 5.5, 100.0)):
        assert row[f"g{i}"] == pytest.approx(math.lgamma(x), abs=1e-12)
    for i, x in enumerate((0.0, 0.2, 0.5, 0.9, 1.0)):  # a polynomial for whole parameters
        assert row[f"b{i}"] == pytest.approx(6 * x**2 - 8 * x**3 + 3 * x**4, abs=1e-12)


def test_importance_statistics(spark):
    rows = [("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, 3.0), ("same", 1, 2.0), ("same", 2, 2.0), ("none", 1, 0.0), ("none", 2, 0.0),
            ("worse", 1, -1.0), ("worse", 2, -1.0), ("single", 1, 5.0)]
    got = {r.feature: r for r in importance_statistics(spark.createDataFrame(rows, "feature string, repeat int, importance double")).collect()}
    a, half = got["a"], 9.9248432009 / math.sqrt(3)
    t = 2 * math.sqrt(3)
    assert (a.importance, a.stddev, a.n) == (2.0, 1.0, 3) and a.p_value == pytest.approx(0.5 - t / (2 * math.sqrt(2 + t * t)), abs=1e-6)
    assert a.p99_low == pytest.approx(2 - half, abs=1e-6) and a.p99_high == pytest.approx(2 + half, abs=1e-6)
    assert (got["same"].p_value, got["same"].p99_low, got["same"].p99_high) == (0.0, 2.0, 2.0)
    assert got["none"].p_value == 0.5 and got["worse"].p_value == 1.0
    assert (got["single"].n, got["single"].p_value, got["single"].p99_low) == (1, None, None)


# ---- closed-form search ----


def regression(spark, n=600, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = rng.gauss(5, 2), rng.gauss(-3, 1)
        e = "one" if i % 3 else "two"
        y = (2 * a - b if e == "one" else 4 + 0.5 * b) + rng.gauss(0, 0.3)
        rows.append((i, e, ("train", "train", "train", "validation", "test")[i % 5], a, b, a + b, 7.0, y))
    rows += [(n, "one", "train", None, 1.0, 1.0, 7.0, 1.0), (n + 1, "one", "train", float("nan"), 1.0, 1.0, 7.0, 1.0), (n + 2, None, "train", 1.0, 1.0, 1.0, 7.0, 1.0),
             (n + 3, "no train", "test", 1.0, 1.0, 1.0, 7.0, 1.0)]
    return spark.createDataFrame(rows, "id long, e string, data_split string, a double, b double, both double, flat double, y double")


def test_search_equals_spark_ml(spark):
    df = regression(spark)
    space = moments.SearchSpace(("a", "b", "both", "flat"), sizes=(1, 2, 3), ridges=(0.0, 0.5))
    table = moments.split_moments(df, space.features, "y", "e")
    assert {r.experiment_id: r.incomplete for r in table.where("data_split = 'train'").collect()} == {"one": 2, "two": 0}
    found = {(r.experiment_id, r.model): r for r in moments.search(table, space).collect()}
    # a constant decides nothing, and three features that hold each other need a penalty
    names = {m for _, m in found}
    assert {e for e, _ in found} == {"one", "two"} and not any("flat" in m for m in names)
    assert "ols:a+b+both" not in names and "ridge_0.5:a+b+both" in names and "ols:a+both" in names
    train = df.where("e = 'one' AND data_split = 'train' AND a IS NOT NULL AND NOT isnan(a)")
    fit = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), LinearRegression(labelCol="y", solver="normal")]).fit(train)
    r, line = found["one", "ols:a+b"], fit.stages[-1]
    assert r.intercept == pytest.approx(line.intercept) and r.weights == pytest.approx(list(line.coefficients))
    scored = fit.transform(df.where("e = 'one' AND data_split = 'validation'")).agg(F.sqrt(F.avg((F.col("y") - F.col("prediction")) ** 2)))
    assert r.validation_rmse == pytest.approx(scored.first()[0])
    ridge = found["one", "ridge_0.5:a"]
    plain = found["one", "ols:a"]
    assert ridge.weights[0] == pytest.approx(plain.weights[0] / 1.5) and ridge.train_rmse > plain.train_rmse


def test_predictions_agree_with_moments(spark):
    df = regression(spark)
    table = moments.split_moments(df, ("a", "b"), "y", "e")
    found = moments.search(table, moments.SearchSpace(("a", "b"), sizes=(1, 2)))
    preds = moments.predict_candidates(df, found, "id", "y", "e").where("data_split = 'test'")
    error = F.sqrt(F.avg((F.col("actual") - F.col("predicted")) ** 2))
    got = {(r.experiment_id, r.model): r.rmse for r in preds.groupBy("experiment_id", "model").agg(error.alias("rmse")).collect()}
    want = {(r.experiment_id, r.model): r.test_rmse for r in found.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)


def test_products_and_empty_table(spark):
    df, names = moments.with_products(regression(spark), ["a", "b"])
    assert names == ["a", "b", "a*b"] and df.select("`a*b`").first()[0] == pytest.approx(df.first().a * df.first().b)
    found = moments.search(moments.split_moments(df, names, "y", "e"), moments.SearchSpace(tuple(names), sizes=(3,)))
    assert {r.model for r in found.collect()} == {"ols:a+b+a*b"}
    empty = moments.split_moments(df.limit(0), names, "y", "e")
    assert moments.search(empty, moments.SearchSpace(tuple(names))).collect() == []


def test_correlations(spark):
    df = regression(spark)
    got = moments.feature_correlations(moments.split_moments(df, ("a", "flat"), "y", "e"), ("a", "flat")).where("experiment_id = 'two'")
    rows = {(r.data_split, r.feature): r.correlation for r in got.collect()}
    want = df.where("e = 'two' AND data_split = 'train'").agg(F.corr("a", "y")).first()[0]
    assert rows["train", "a"] == pytest.approx(want) and rows["train", "flat"] is None


# ---- blends ----


def plain_greedy(gram, rounds):
    k, counts = len(gram), [0] * len(gram)
    for _ in range(rounds):
        scores = []
        for c in range(k):
            w = [counts[i] + (i == c) for i in range(k)]
            scores.append(round(sum(w[i] * w[j] * gram[i][j] for i in range(k) for j in range(k)) / max(gram[i][i] for i in range(k)), 7))
        counts[scores.index(min(scores))] += 1
    return counts


def test_fold_equals_plain_loop(spark):
    rng = np.random.default_rng(1)
    grams = []
    for k in (1, 2, 5, 8):
        e = rng.normal(size=(60, k)) + rng.normal(size=(60, 1))
        grams.append((str(k), (e.T @ e / 60).tolist()))
    grams.append(("tied", [[1.0, 1.0], [1.0, 1.0]]))
    df = spark.createDataFrame(grams, "experiment_id string, gram array<array<double>>")
    got = {r.experiment_id: r.c for r in df.select("experiment_id", blend.greedy_counts(F.col("gram"), 15).alias("c")).collect()}
    assert got == {name: plain_greedy(g, 15) for name, g in grams}
    assert got["tied"] == [15, 0]


def test_blend_of_two_experiments(spark):
    rows = [(e, m, i, s, float(i), float(i) + d) for e, ds in (("x", (1.0, -1.0)), ("y", (0.1, 5.0)))
            for m, d in zip("ab", ds) for i in range(6) for s in [("validation", "test")[i % 2]]]
    rows += [("z", "a", 1, "validation", 1.0, 2.0), ("z", "a", 3, "validation", 1.0, 2.0), ("z", "b", 1, "validation", 1.0, 1.0)]  # b lacks a row
    preds = spark.createDataFrame(rows, "experiment_id string, model string, row_id int, data_split string, actual double, predicted double")
    weights = blend.blend_weights(blend.error_matrices(preds, ["a", "b"]), 10)
    got = {(r.experiment_id, r.model): r.weight for r in weights.collect()}
    assert got == {("x", "a"): 0.5, ("x", "b"): 0.5, ("y", "a"): 1.0, ("z", "a"): 1.0}
    mixed = blend.blended(preds, weights).where("experiment_id = 'x'")
    assert all(r.predicted == pytest.approx(r.actual) for r in mixed.collect()) and mixed.count() == 6
    costs = spark.createDataFrame([(e, m, c) for e in "xyz" for m, c in (("a", 10), ("b", 20))], "experiment_id string, model string, fit_cells int")
    own = spark.createDataFrame([(e, 3) for e in "xyz"], "experiment_id string, fit_cells int")
    out = {(r.experiment_id, r.model): (r.fit_cells_marginal, r.fit_cells_total) for r in blend.blend_costs(weights, costs, "fit_cells", own).collect()}
    assert out["x", blend.BLEND] == (3, 33) and out["y", blend.BLEND] == (3, 13) and out["x", "b"] == (20, 20)


def test_a_row_predicted_twice_fails(spark):
    rows = [("x", "a", 1, "validation", 1.0, 2.0), ("x", "a", 1, "validation", 1.0, 3.0)]
    preds = spark.createDataFrame(rows, "experiment_id string, model string, row_id int, data_split string, actual double, predicted double")
    with pytest.raises(Exception, match="predicted twice"):
        blend.error_matrices(preds, ["a"]).collect()


# ---- trees ----


def test_cuts_against_all_splits(spark):
    rng = random.Random(6)
    rows = [("e", float(rng.randrange(8)), float(rng.randrange(3)), 1.0, 0.0) for _ in range(300)]
    rows = [(e, a, b, c, (10.0 if a > 4 else 1.0) + b + rng.random()) for e, a, b, c, _ in rows] + [("e", None, 1.0, 1.0, 5.0), ("e", 1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "e string, a double, b double, c double, y double")
    cuts = {r.feature: r for r in stump.best_cuts(stump.feature_cells(df, ["a", "b", "c"], "y", "e", bins=8)).collect()}
    assert set(cuts) == {"a", "b"}  # c never varies

    def removed(values, at):
        left, right = [y for v, y in values if v <= at], [y for v, y in values if v > at]
        sse = lambda ys: sum((y - sum(ys) / len(ys)) ** 2 for y in ys) if ys else 0.0
        return sse([y for _, y in values]) - sse(left) - sse(right)

    for i, f in ((1, "a"), (2, "b")):
        values = [(r[i], r[4]) for r in rows if r[i] is not None and r[4] is not None]
        assert cuts[f].gain == pytest.approx(max(removed(values, at) for at in range(8)), rel=1e-6)
    best = stump.fit_stumps(stump.best_cuts(stump.feature_cells(df, ["a", "b", "c"], "y", "e", bins=8))).first()
    assert best.feature == "a" and best.cut_cell == 4 and best.left_mean < 4 < best.right_mean
    imp = {r.variable: r.relative_importance for r in stump.stump_importance(stump.best_cuts(stump.feature_cells(df, ["a", "b", "c"], "y", "e", 8)), ["a", "b", "c"]).collect()}
    assert imp["c"] == 0.0 and imp["a"] > imp["b"] > 0


def test_best_ranked_model_with_importances(spark):
    board = spark.createDataFrame([("x", "m1", 1.0), ("x", "tree", 2.0), ("x", "other", 3.0), ("y", "m1", 1.0), ("y", "other", 2.0)],
                                  "experiment_id string, model string, validation_rmse double")
    tree = spark.createDataFrame([("x", "a", 0.5), ("y", "a", 0.1)], "experiment_id string, variable string, relative_importance double")
    other = spark.createDataFrame([("x", "a", 9.0), ("y", "a", 8.0)], tree.schema)
    models = [stump.RankedModel("m1"), stump.RankedModel("tree", tree), stump.RankedModel("other", other)]
    got = {r.experiment_id: (r.model, r.relative_importance) for r in stump.best_model_importance(board, models).collect()}
    assert got == {"x": ("tree", 0.5), "y": ("other", 8.0)}
    with pytest.raises(Exception, match="no model with importances in y; checked: m1"):
        stump.best_model_importance(board, models, max_models=1).where("experiment_id = 'y'").collect()
    with pytest.raises(Exception, match="checked: m1, other"):
        stump.best_model_importance(board, [stump.RankedModel("m1"), stump.RankedModel("other")]).where("experiment_id = 'y'").collect()


# ---- costs ----


def test_costs_come_from_the_pass(spark):
    df = spark.createDataFrame([(1.0, "x", 2.0), (None, "y", 3.0), (3.0, None, 4.0)], "a double, b string, y double")
    _, c = cost.measured(df, ["a", "b"])
    assert (c.rows, c.cells) == (3, 4) and c.seconds > 0

    def fit(train):
        mean = train.agg(F.avg("y")).first()[0]
        return lambda rows: rows.withColumn("predicted", F.lit(mean) + F.coalesce("a", F.lit(0.0)))

    table = cost.cost_columns(cost.measured_costs(spark, df, df.limit(2), "y", {"m": (["a"], fit)})).first()
    assert (table.model, table.fit_rows, table.fit_cells, table.predict_rows, table.predict_cells_per_row) == ("m", 3, 5, 2, 0.5)
    assert table.fit_seconds > 0 and table.predict_seconds_per_row > 0


# ---- external models ----


def short_scorer():
    class Short:  # a local class travels with its instance
        def predict(self, rows):
            return np.zeros(max(0, len(rows) - 1))

    return Short()


def test_external_equals_pipeline(spark):
    df = regression(spark).where("a IS NOT NULL AND NOT isnan(a)")
    fit = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), LinearRegression(labelCol="y")]).fit(df)
    line = fit.stages[-1]
    got = external.score_external(df, external.LinearScorer(line.intercept, line.coefficients.toArray()), ["a", "b"], ["id", "e"], batch_rows=7)
    want = {r.id: r.prediction for r in fit.transform(df).select("id", "prediction").collect()}
    rows = got.collect()
    assert got.columns == ["id", "e", "predicted"] and len(rows) == len(want)
    assert all(r.predicted == pytest.approx(want[r.id], rel=1e-12) for r in rows)


def test_external_guards(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("inf"))], "id int, a double")
    scorer = external.LinearScorer(1.0, [2.0])
    assert {r.id: r.predicted for r in external.score_external(df, scorer, ["a"], ["id"]).collect()} == {1: 3.0, 2: None, 3: None}
    assert external.score_external(df.limit(0), scorer, ["a"], ["id"]).collect() == []
    with pytest.raises(Exception, match="predictions of shape"):
        external.score_external(df, short_scorer(), ["a"], ["id"]).collect()
    with pytest.raises(ValueError, match="may be broadcast"):
        external.score_external(df, scorer, ["a"], ["id"], max_model_bytes=10)
    with pytest.raises(ValueError, match="clash"):
        external.score_external(df.withColumnRenamed("id", "predicted"), scorer, ["a"], ["predicted"])


# ---- sketches ----


def test_sketches_of_later_files_are_united(spark, tmp_path):
    path, kept = str(tmp_path / "t"), str(tmp_path / "s")
    rows = lambda lo, hi: spark.range(lo, hi).select(F.col("id"), (F.col("id") % 10).cast("string").alias("few"),
                                                    F.when(F.col("id") % 2 == 0, F.col("id").cast("double")).otherwise(F.lit(float("nan"))).alias("half"))
    rows(0, 6000).repartition(3).write.parquet(path)
    sketches.file_sketches(spark.read.parquet(path), ["id", "few", "half"]).write.parquet(kept)
    rows(4000, 9000).coalesce(1).write.parquet(path + "2")
    sketches.file_sketches(spark.read.parquet(path + "2"), ["id", "few", "half"]).write.mode("append").parquet(kept)
    stored = spark.read.parquet(kept)
    assert stored.select("file").distinct().count() == 4
    exact = spark.createDataFrame([("id", 9000), ("few", 10), ("half", 4500)], "column string, unique_count long")
    got = {r["column"]: r for r in sketches.check_estimates(sketches.approximate_profile(stored), exact).collect()}
    assert all(r.within_bound and r.rows == 11000 for r in got.values())
    assert got["half"].missing == 5500 and got["few"].approx_unique == 10


# ---- artifacts ----


def test_artifacts(spark, tmp_path):
    base = tmp_path / "it's here"
    (base / "a" / "b").mkdir(parents=True)
    (base / "a" / "b" / "full.json").write_text("{}")
    (base / "a" / "empty.csv").write_text("")
    wanted = ["a", "a/b", "a/b/full.json", "a/empty.csv", "a/b/full", "c", "a/"]
    expected = spark.createDataFrame([(w, "file") for w in wanted] + [("nowhere", "table")], "artifact string, kind string")
    got = {r.table_name: (r.status, r.details) for r in gates.check_exists(expected, gates.artifact_listing(spark, str(base), ["nowhere"])).collect()}
    assert got == {"a": ("PASS", "present"), "a/b": ("PASS", "present"), "a/b/full.json": ("PASS", "present"), "a/empty.csv": ("WARN", "empty"),
                   "a/b/full": ("FAIL", "absent"), "c": ("FAIL", "absent"), "nowhere": ("FAIL", "absent")}
    nothing = gates.artifact_listing(spark, str(tmp_path / "none"))
    assert nothing.collect() == [] and gates.check_exists(expected, nothing).where("status = 'FAIL'").count() == 7
    assert gates.gate_status(gates.expectation_table([gates.check_exists(expected, nothing)])).first().gate_status == "FAIL"


def test_search_space_names():
    space = moments.SearchSpace(("a", "b", "c"), sizes=(1, 3), ridges=(0.0, 0.25))
    assert [n for n, *_ in space.candidates()] == ["ols:a", "ridge_0.25:a", "ols:b", "ridge_0.25:b", "ols:c", "ridge_0.25:c", "ols:a+b+c", "ridge_0.25:a+b+c"]
    assert all(list(c) == sorted(c) for _, c, _ in space.candidates()) and len(list(itertools.islice(space.candidates(), 2))) == 2
