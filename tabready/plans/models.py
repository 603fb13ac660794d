"""The documents regression experiment: closed-form candidates searched per
platform on a fixed validation split, as in the reference's training runs
(Entry B) and their comparison (Entry C), with every step a Spark job.

Platforms stand in for the reference's engines: ``group_means`` and
``least_squares`` are searched like AutoML platforms (best candidate on the
validation split), ``baseline`` holds the fixed baseline models.  Each
platform runs twice: with all features and with the top features ranked by
absolute correlation with the target on the train split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabready.operators.candidates import Candidate, candidate_costs, candidate_predictions
from tabready.operators.compare import EXP, normalize_run_rows
from tabready.operators.leaderboard import top_features
from tabready.operators.metrics import model_validation_table
from tabready.operators.moments import split_moments
from tabready.operators.profile import target_correlation
from tabready.session import staged
from tabready.plans.standins import DOC_CATEGORICAL, DOC_NUMERIC, DOC_TARGET, doc_inputs, doc_splits

EXPERIMENT = "documents_n_chars"
TOP_K = 2
BASELINE_MODEL = "ols_word_count"
#: Features of the closed-form search; all sets of one to three of them.
SEARCH_FEATURES = ("word_count", "line_count", "words_per_line")
RIDGES = (0.0, 0.1)
ALL_DOC_FEATURES = (*DOC_NUMERIC, *DOC_CATEGORICAL)

CANDIDATES = (
    Candidate("mean", "mean", (), None),
    Candidate("mean_by_lang", "group_mean", ("lang",), "lang"),
    Candidate("mean_by_source", "group_mean", ("source",), "source"),
    Candidate("mean_by_word_bucket", "group_mean", ("word_count",), "floor(word_count / 50)"),
    Candidate("mean_by_line_bucket", "group_mean", ("line_count",), "floor(line_count / 5)"),
    Candidate("ols_word_count", "ols", ("word_count",), None),
    Candidate("ols_line_count", "ols", ("line_count",), None),
    Candidate("ols_word_by_lang", "group_ols", ("lang", "word_count"), "lang"),
)
PLATFORMS = {
    "group_means": ("mean_by_lang", "mean_by_source", "mean_by_word_bucket", "mean_by_line_bucket"),
    "least_squares": ("ols_word_count", "ols_line_count", "ols_word_by_lang"),
}
BASELINES = ("mean", "ols_word_count")
BASELINE_PLATFORM = "baseline"
#: What a run costs, by column of the runs table and of the summaries: cells
#: read, as seconds would differ from run to run.
COSTS = {"training_cells": "training_cells", "prediction_cells": "prediction_cells"}


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Every candidate's prediction for every document and split (staged)."""
    return staged(spark, f"doc_predictions:{sf}",
                  lambda: candidate_predictions(doc_splits(spark, sf), CANDIDATES, "doc_id", DOC_TARGET), doc_inputs(sf))


def experiment_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """The same, an experiment per language (staged)."""
    def build():
        docs = doc_splits(spark, sf).filter(F.col("lang").isNotNull()).withColumn(EXP, F.concat(F.lit(f"{EXPERIMENT}_"), "lang"))
        return candidate_predictions(docs, CANDIDATES, "doc_id", DOC_TARGET, keep=[EXP])
    return staged(spark, f"doc_experiment_predictions:{sf}", build, doc_inputs(sf))


def experiment_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    """A13 per experiment and candidate."""
    return model_validation_table(experiment_predictions(spark, sf), candidate_costs(doc_splits(spark, sf), CANDIDATES), by=[EXP])


def experiment_moments(spark: SparkSession, sf: str) -> DataFrame:
    """Moments of the search's features per language and split (staged)."""
    def build():
        docs = with_search_features(doc_splits(spark, sf)).withColumn(EXP, F.concat(F.lit(f"{EXPERIMENT}_"), "lang"))
        return split_moments(docs, SEARCH_FEATURES, DOC_TARGET, EXP)
    return staged(spark, f"doc_moments:{sf}", build, doc_inputs(sf))


def with_search_features(docs: DataFrame) -> DataFrame:
    """The features of the closed-form search."""
    return docs.withColumn("words_per_line", F.col("word_count") / F.col("line_count"))


def leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    """A13 per candidate: validation/test metrics and cost proxies."""
    return model_validation_table(predictions(spark, sf), candidate_costs(doc_splits(spark, sf), CANDIDATES))


def ranked_correlations(spark: SparkSession, sf: str) -> DataFrame:
    """Numeric features ranked by |corr| with the target on train."""
    train = doc_splits(spark, sf).filter(F.col("data_split") == "train")
    corr = target_correlation(train, DOC_NUMERIC, DOC_TARGET)
    return corr.withColumn(EXP, F.lit(EXPERIMENT)).withColumn(
        "importance_rank", F.row_number().over(Window.partitionBy(EXP).orderBy(F.desc("abs_correlation"), "feature"))
    )


def experiment_top_features(spark: SparkSession, sf: str) -> DataFrame:
    """The top-k feature names of the experiment as an ordered array."""
    return top_features(ranked_correlations(spark, sf), TOP_K, by=[EXP])


def _membership(spark: SparkSession) -> DataFrame:
    feats = {c.name: list(c.features) for c in CANDIDATES}
    rows = [(EXPERIMENT, p, m, feats[m]) for p, ms in PLATFORMS.items() for m in ms]
    return spark.createDataFrame(rows, "experiment_id string, platform string, model string, features array<string>")


def run_summaries(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """One summary row per (platform, feature set) search, and one baseline
    summary per experiment with a ``models`` array, shaped like the
    reference's run-summary documents."""
    splits = doc_splits(spark, sf)
    lb = leaderboard(spark, sf)
    n_test = splits.filter(F.col("data_split") == "test").agg(F.count(F.lit(1))).scalar()
    top = experiment_top_features(spark, sf)
    members = _membership(spark).join(top, EXP)
    sets = members.select(
        "*",
        F.explode(F.array(
            F.struct(F.lit("all_features").alias("feature_set"),
                     F.lit(list(ALL_DOC_FEATURES)).cast("array<string>").alias("set_features")),
            F.struct(F.lit("top_features").alias("feature_set"), F.col("top_features").alias("set_features")),
        )).alias("fs"),
    ).select(EXP, "platform", "model", "features", "fs.feature_set", "fs.set_features")
    eligible = sets.filter(F.size(F.array_except("features", "set_features")) == 0).join(lb, "model")
    w = Window.partitionBy(EXP, "platform", "feature_set")
    searched = eligible.withColumn("_r", F.row_number().over(w.orderBy("validation_rmse", "model"))).withColumn(
        "training_cells", F.sum("fit_cells").over(w)
    )
    automl = searched.filter(F.col("_r") == 1).select(
        EXP, "platform", "feature_set",
        F.size("set_features").alias("feature_count"),
        F.col("model").alias("best_model"),
        "validation_rmse", "test_rmse", F.col("test_mae"), F.col("test_r2"),
        "training_cells",
        (F.col("predict_cells_per_row") * n_test).alias("prediction_cells"),
        F.col("set_features").alias("model_features"),
    )
    feats = {c.name: list(c.features) for c in CANDIDATES}
    base_meta = spark.createDataFrame([(EXPERIMENT, m, feats[m]) for m in BASELINES],
                                      "experiment_id string, model string, model_features array<string>")
    base = base_meta.join(lb, "model").select(
        EXP,
        F.struct(
            F.lit("all_features").alias("feature_set"),
            F.size("model_features").alias("feature_count"),
            F.col("model").alias("model_name"),
            "validation_rmse", "test_rmse", "test_mae", "test_r2",
            F.col("fit_cells").alias("training_cells"),
            (F.col("predict_cells_per_row") * n_test).alias("prediction_cells"),
            "model_features",
        ).alias("m"),
    ).groupBy(EXP).agg(F.collect_list("m").alias("models"))
    return automl, base


def runs_table(spark: SparkSession, sf: str) -> DataFrame:
    """L16 applied to the run summaries: uniform comparison rows.  Staged, as
    the comparison step reads written run summaries, not the training plans."""
    def build():
        automl, base = run_summaries(spark, sf)
        return normalize_run_rows(automl, base, BASELINE_PLATFORM, COSTS)
    return staged(spark, f"runs:{sf}", build, doc_inputs(sf))
