"""Preprocessing, training, candidate search, blending and scoring
(L1-L4, L6-L9, L13) on ``pyspark.ml``.

Fitting runs as Spark jobs over the (cached) train split; the driver only
holds fitted models, per-model timings and a k x k validation error matrix.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor,
)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabready.functions.cleaning import present
from tabready.operators import cells
from tabready.session import delete_folder, ensure_checkpoint_dir


# ---- L1 / L2: imputation fitted on train ------------------------------------

def _cells(df: DataFrame, columns: Sequence[str], cast: str | None = None) -> DataFrame:
    """``(_column, _value)`` for every non-NULL cell of ``columns`` (unpivot)."""
    cells = [F.struct(F.lit(c).alias("_column"), (present(df, c).cast(cast) if cast else present(df, c)).alias("_value"))
             for c in columns]
    return df.select(F.explode(F.array(*cells)).alias("_cell")).select("_cell.*").filter(F.col("_value").isNotNull())


def fit_median_imputer(train: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """L1: exact median per numeric column (``ml.Imputer`` is approximate,
    H6), by bounded histogram narrowing, all columns in one grouped run.
    The result is one value per column."""
    from tabready.operators.quantiles import exact_quantiles

    if not columns:
        return {}
    rows = exact_quantiles(_cells(train, columns, "double"), "_value", [0.5], ["_column"], names=["m"]).collect()
    found = {r["_column"]: r["m"] for r in rows}
    return {c: found.get(c) for c in columns}


def fit_mode_imputer(train: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """L2: most frequent value per column, ties to the smallest, NULLs ignored.

    Counted per (column, value) with partial aggregation, then the top value
    per column -- a hot value is one counter, and no task holds a column's
    whole value map (as the ``mode`` aggregate would)."""
    if not columns:
        return {}
    from tabready.contract import is_numeric_type

    types = {f.name: f.dataType for f in train.schema.fields}
    numeric = [c for c in columns if is_numeric_type(types[c])]
    counts = _cells(train, columns, "string").groupBy("_column", "_value").agg(F.count(F.lit(1)).alias("_n"))
    # ties: the smallest value in the column's own type, as ``mode(deterministic)``
    num = F.when(F.col("_column").isin(*numeric), F.col("_value").cast("double")) if numeric else F.lit(None)
    top = counts.withColumn("_r", F.row_number().over(
        Window.partitionBy("_column").orderBy(F.col("_n").desc(), num.asc_nulls_last(), F.col("_value"))))
    found = {r["_column"]: r["_value"] for r in top.filter(F.col("_r") == 1).select("_column", "_value").collect()}
    return {c: _typed(found[c], types[c]) if c in numeric and found.get(c) is not None else found.get(c)
            for c in columns}


def _typed(v: str, dtype) -> object:
    """A numeric mode read back from its string form."""
    from pyspark.sql import types as T

    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return int(v)
    return float(v)


def apply_imputer(df: DataFrame, fill: dict[str, object]) -> DataFrame:
    """Replace NULL and NaN by the fitted values (a projection, no job)."""
    return df.withColumns({c: F.coalesce(present(df, c), F.lit(v)) for c, v in fill.items() if v is not None})


# ---- L3 / L4: encoding and assembly -------------------------------------------

def one_hot_stages(categoricals: Sequence[str]) -> list:
    """L3: alphabetical indices, unseen and NULL to the kept-then-dropped
    last slot, so unknown categories encode as all zeros (H6)."""
    stages = []
    for c in categoricals:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCol=f"{c}__idx", outputCol=f"{c}__ohe", dropLast=True))
    return stages


def feature_pipeline(numeric: Sequence[str], categoricals: Sequence[str]) -> list:
    """L3 + L4: one-hot encoders then one ``features`` vector."""
    return [*one_hot_stages(categoricals),
            VectorAssembler(inputCols=[*numeric, *[f"{c}__ohe" for c in categoricals]], outputCol="features",
                            handleInvalid="keep")]


def one_hot_array(df: DataFrame, train: DataFrame, column: str) -> DataFrame:
    """L3 on one column, as a plain ``array<double>`` column ``<column>_one_hot``."""
    model = Pipeline(stages=one_hot_stages([column])).fit(train)
    return model.transform(df).withColumn(f"{column}_one_hot", vector_to_array(f"{column}__ohe")).drop(
        f"{column}__idx", f"{column}__ohe")


def vector_slot_names(df: DataFrame, col: str = "features") -> list[tuple[int, str]]:
    """ML attribute metadata of an assembled vector: ``(slot, name)`` pairs."""
    meta = df.schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    out = []
    for group in meta.values():
        for a in group:
            out.append((a["idx"], a["name"]))
    return sorted(out)


# ---- L6 / L7: estimators and search ---------------------------------------------

def random_forest(num_trees: int = 300, max_depth: int = 20, min_leaf: int = 2, seed: int = 42,
                  label: str = "label") -> RandomForestRegressor:
    """The reference baseline (300 trees, depth 20, min leaf 2, sqrt features)."""
    return RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=num_trees, maxDepth=max_depth,
                                 minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt", seed=seed)


#: Tree nodes that the driver holds at a time while a forest is fitted in parts:
#: as objects of Spark's, and as arrays of 17 bytes a node.
FOREST_NODES, CELL_NODES = 200_000, 2_000_000


def forest_predictions(train: DataFrame, df: DataFrame, numeric: Sequence[str], categoricals: Sequence[str],
                       forest: RandomForestRegressor, nodes: int | None = None) -> DataFrame:
    """L6 on large tables: ``df`` with the ``prediction`` of the whole ``forest``.

    A fit returns all of its trees to the driver, and deep trees grow with the
    rows.  So the trees are fitted in parts of about ``nodes`` tree nodes, each
    on all training rows and with a seed of its own; each part adds the sum of
    its trees' predictions to a written table and is let go.  The first part
    is sized by the most nodes that the rows and the depth allow, the next ones
    by the nodes that trees turned out to have.  A single tree is never divided.

    Trees see rows by their bins, so they are fitted and predict on cells, rows
    with the same bins (``tabready.operators.cells``), each tree in one task.  If
    the cells are too many for a task, Spark fits on rows.
    """
    prep = Pipeline(stages=feature_pipeline(numeric, categoricals)).fit(train)
    # the bootstrap draws by place: rows are dealt to all cores and ordered, however the table was written
    cores, count = train.sparkSession.sparkContext.defaultParallelism, train.count()
    tasks = max(cores, train.rdd.getNumPartitions(), -(-count // cells.BLOCK))
    dealt = train.repartition(tasks, *train.columns).sortWithinPartitions(*train.columns)
    cuts = cells.bin_thresholds(prep.transform(train), "features", min(forest.getMaxBins(), max(2, count)))
    rows = cells.with_cell(prep.transform(dealt), "features", cuts).select(cells.CELL, forest.getLabelCol()).cache()
    y = F.col(forest.getLabelCol())
    kinds, center, lost = rows.agg(F.count_distinct(cells.CELL), F.avg(y), F.count_if(y.isNull() | F.isnan(y) | (F.abs(y) == float("inf")))).first()
    if cells.fits(forest, cuts, kinds) and not lost:  # Spark's fit rejects lost labels
        out = _cell_predictions(rows, cells.with_cell(prep.transform(df), "features", cuts).select(*df.columns, cells.CELL),
                                forest, cells.CellForest().on(cuts, center), kinds, nodes or CELL_NODES)
        rows.unpersist()
        return out
    rows.unpersist()
    return _row_predictions(prep, dealt, df, forest, nodes or FOREST_NODES)


def _cell_predictions(rows: DataFrame, df: DataFrame, forest: RandomForestRegressor, on_cells: cells.CellForest,
                      kinds: int, nodes: int) -> DataFrame:
    """``df``, which has cells, with the mean prediction of all trees."""
    spark, columns = df.sparkSession, [c for c in df.columns if c != cells.CELL]
    base = f"{ensure_checkpoint_dir(spark)}/forest"
    table = f"{base}/{uuid.uuid4().hex}"
    df.write.mode("error").parquet(table)
    df = spark.read.schema(df.schema).parquet(table)
    total, seed = forest.getNumTrees(), forest.getSeed()
    most = min(2 ** (forest.getMaxDepth() + 1), 2 * kinds)
    for p in forest.params:
        if forest.isDefined(p) and on_cells.hasParam(p.name):
            on_cells.set(on_cells.getParam(p.name), forest.getOrDefault(p))
    tasks = max(spark.sparkContext.defaultParallelism, df.rdd.getNumPartitions())
    scored, path = df.select(cells.CELL).distinct().repartition(tasks, cells.CELL).withColumn("_sum", F.lit(0.0)), None
    done, part = 0, max(1, min(total, nodes // most))
    while done < total:
        model = on_cells.copy({on_cells.numTrees: part, on_cells.seed: seed + 1_000_003 * done}).fit(rows)
        added = model.transform(scored).select(cells.CELL, (F.col("_sum") + F.col("prediction") * part).alias("_sum"))
        before, path = path, f"{base}/{uuid.uuid4().hex}"
        added.write.mode("error").parquet(path)
        scored = spark.read.schema("_cell binary, _sum double").parquet(path)
        if before:
            delete_folder(spark, before)
        done += part
        part = max(1, min(total - done, nodes * part // model.totalNumNodes))
        del model, added
    return df.join(scored, cells.CELL).select(*columns, (F.col("_sum") / total).alias("prediction"))


def _row_predictions(prep: PipelineModel, dealt: DataFrame, df: DataFrame, forest: RandomForestRegressor,
                     nodes: int) -> DataFrame:
    """The same by Spark's own fits on rows, for any number of cells."""
    total, seed, label = forest.getNumTrees(), forest.getSeed(), forest.getLabelCol()
    rows = prep.transform(dealt).select("features", label).cache()
    most = min(2 ** (forest.getMaxDepth() + 1), 2 * max(1, rows.count() // forest.getMinInstancesPerNode()))
    done, part = 0, max(1, min(total, nodes // most))
    spark, scored, path = df.sparkSession, df.withColumn("_sum", F.lit(0.0)), None
    while done < total:
        model = forest.copy({forest.numTrees: part, forest.seed: seed + 1_000_003 * done}).fit(rows)
        added = model.transform(prep.transform(scored)).withColumn("_sum", F.col("_sum") + F.col("prediction") * part)
        before, path = path, f"{ensure_checkpoint_dir(spark)}/forest/{uuid.uuid4().hex}"
        added.select(*df.columns, "_sum").write.mode("error").parquet(path)
        scored = spark.read.schema(scored.schema).parquet(path)
        if before:
            delete_folder(spark, before)
        done += part
        part = max(1, min(total - done, nodes * part // model.totalNumNodes))
        del model, added
    rows.unpersist()
    return scored.select(*df.columns, (F.col("_sum") / total).alias("prediction"))


def default_candidates(label: str = "label", seed: int = 42, scale: str = "small") -> dict[str, object]:
    """L7 search space: linear, tree, forest and boosted-tree regressors."""
    depth, trees, iters = (6, 30, 20) if scale == "small" else (10, 200, 100)
    return {
        "LinearRegression": LinearRegression(featuresCol="features", labelCol=label, regParam=0.0),
        "RidgeRegression": LinearRegression(featuresCol="features", labelCol=label, regParam=0.1,
                                            elasticNetParam=0.0),
        "DecisionTree": DecisionTreeRegressor(featuresCol="features", labelCol=label, maxDepth=depth, seed=seed),
        "RandomForest": RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=trees,
                                              maxDepth=depth, seed=seed),
        "GBT": GBTRegressor(featuresCol="features", labelCol=label, maxIter=iters, maxDepth=min(depth, 5),
                            seed=seed),
    }


@dataclass
class FittedCandidate:
    name: str
    model: PipelineModel
    fit_seconds: float


def score_split(model: PipelineModel, df: DataFrame, identifier: str, label: str) -> tuple[DataFrame, float]:
    """Predict a frame; the materialising write runs inside the timer.

    Returns the prediction frame ``(row_id, actual, predicted)`` and the
    wall-clock seconds of one full pass.
    """
    out = model.transform(df).select(F.col(identifier).alias("row_id"), F.col(label).alias("actual"),
                                     F.col("prediction").alias("predicted"))
    t0 = time.perf_counter()
    out.write.format("noop").mode("overwrite").save()
    return out, time.perf_counter() - t0


def candidate_search(
    train: DataFrame,
    numeric: Sequence[str],
    categoricals: Sequence[str],
    label: str,
    estimators: dict[str, object],
    max_models: int | None = None,
    time_limit_seconds: float | None = None,
    excluded: Sequence[str] = (),
    parallelism: int = 2,
) -> list[FittedCandidate]:
    """Fit candidates on the fixed train split.  ``max_models``, excluded
    families and a deadline are checked before each submission; fits run in
    a small driver thread pool, each one an ordinary Spark ML job.  All fits
    share one job group, cancelled again and again once the deadline has passed,
    so a fit that overruns the budget stops at its next job and is left out; a
    fit that finishes is kept."""
    names = [n for n in estimators if n not in excluded]
    if max_models is not None:
        names = names[:max_models]
    prep = feature_pipeline(numeric, categoricals)
    deadline = time.monotonic() + time_limit_seconds if time_limit_seconds else None
    sc = train.sparkSession.sparkContext
    group = f"candidate-search-{uuid.uuid4().hex}"

    def expired() -> bool:
        return deadline is not None and time.monotonic() > deadline

    def fit(name: str) -> FittedCandidate | None:
        if expired():
            return None
        sc.setJobGroup(group, f"candidate {name}", interruptOnCancel=True)
        t0 = time.perf_counter()
        try:
            model = Pipeline(stages=[*prep, estimators[name]]).fit(train)
        except Exception:
            if expired():  # cancelled at the deadline
                return None
            raise
        return FittedCandidate(name, model, time.perf_counter() - t0)

    done = threading.Event()

    def stop_late_jobs() -> None:
        done.wait(max(0.0, deadline - time.monotonic()))
        while not done.is_set():  # a fit may be between two jobs
            sc.cancelJobGroup(group)
            done.wait(0.2)

    if deadline is not None:
        threading.Thread(target=stop_late_jobs, daemon=True).start()
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            results = list(pool.map(fit, names))
    finally:
        done.set()
    return [r for r in results if r is not None]


def long_predictions(fitted: Sequence[FittedCandidate], df: DataFrame, identifier: str, label: str,
                     split_col: str = "data_split") -> DataFrame:
    """Every fitted candidate's predictions as one long table."""
    parts = [
        f.model.transform(df).select(F.lit(f.name).alias("model"), F.col(identifier).alias("row_id"),
                                     F.col(split_col).alias("data_split"), F.col(label).alias("actual"),
                                     F.col("prediction").alias("predicted"))
        for f in fitted
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- L8: greedy weighted ensemble ------------------------------------------------

def error_gram_matrix(preds: DataFrame, models: Sequence[str], split_label: str = "validation") -> list[list[float]]:
    """``G[i][j] = avg(e_i * e_j)`` over the validation rows, one aggregate.

    The long table is pivoted on the known model list (a k-column pivot), so
    the driver receives k x k numbers whatever the row count.
    """
    wide = (preds.filter(F.col("data_split") == split_label)
            .withColumn("_e", F.col("actual") - F.col("predicted"))
            .groupBy("row_id").pivot("model", list(models)).agg(F.when(F.count("_e") > 1, F.raise_error(F.lit(
                "a row is predicted twice by one model"))).otherwise(F.max("_e"))))
    k = len(models)
    aggs = [F.avg(F.col(f"`{models[i]}`") * F.col(f"`{models[j]}`")).alias(f"g_{i}_{j}")
            for i in range(k) for j in range(i, k)]
    row = wide.agg(*aggs).first()
    g = [[0.0] * k for _ in range(k)]
    for i in range(k):
        for j in range(i, k):
            g[i][j] = g[j][i] = float(row[f"g_{i}_{j}"])
    return g


def greedy_ensemble_weights(gram: list[list[float]], models: Sequence[str], rounds: int = 25) -> dict[str, float]:
    """Ensemble selection with replacement on the error matrix.  A blend
    with weights ``w`` has validation MSE ``w^T G w``; each round adds the
    model that lowers it most (ties to the earlier model)."""
    k = len(models)
    counts = [0] * k
    for _ in range(rounds):
        best, best_mse = None, None
        n = sum(counts) + 1
        for c in range(k):
            w = [(counts[i] + (1 if i == c else 0)) / n for i in range(k)]
            mse = sum(w[i] * w[j] * gram[i][j] for i in range(k) for j in range(k))
            if best_mse is None or mse < best_mse - 1e-12:
                best, best_mse = c, mse
        counts[best] += 1
    total = sum(counts)
    return {models[i]: counts[i] / total for i in range(k) if counts[i]}


def blend_predictions(preds: DataFrame, weights: dict[str, float], name: str = "WeightedEnsemble") -> DataFrame:
    """The blended prediction per row: ``sum(w_m * predicted_m)`` grouped by row."""
    w = F.create_map(*[x for m, v in weights.items() for x in (F.lit(m), F.lit(v))])
    return (preds.filter(F.col("model").isin(*weights.keys()))
            .groupBy("row_id", "data_split")
            .agg(F.max("actual").alias("actual"), F.sum(w[F.col("model")] * F.col("predicted")).alias("predicted"))
            .withColumn("model", F.lit(name)))


def leaderboard_from_predictions(preds: DataFrame, fit_seconds: dict[str, float]) -> DataFrame:
    """A13 for fitted models: validation/test metrics next to wall-clock fit time."""
    from tabready.operators.metrics import model_validation_table

    spark = preds.sparkSession
    costs = spark.createDataFrame([(k, float(v)) for k, v in fit_seconds.items()], "model string, fit_time double")
    return model_validation_table(preds, costs)

