"""Cross-run comparison and recommendation.

The runs table has one row per run: ``experiment_id, platform, feature_set,
feature_count, best_model, validation_rmse, test_rmse, test_mae, test_r2,
training_seconds, prediction_seconds (or other costs), is_automl, model_features``.  Every
operator is partitioned by ``experiment_id``, so thousands of experiments
are compared in one job; pairs are formed by equi-joins on
``(experiment_id, platform)``, never all pairs in a group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabready.functions.arithmetic import percent_change

EXP = "experiment_id"
SCORES = ("validation_rmse", "test_rmse", "test_mae", "test_r2")
REQUIRED_RUN_FIELDS = ("platform", "feature_set", "feature_count", "best_model", *SCORES)
#: What training and prediction cost, in this order: the column of the runs table
#: and the field of the summaries.  Any measure will do (seconds, cells read).
SECONDS = {"training_seconds": "training_wall_clock_seconds", "prediction_seconds": "prediction_seconds"}
ALL_FEATURES, TOP_FEATURES = "all_features", "top_features"


def _uniform(df: DataFrame, is_automl: bool, costs: Mapping[str, str], platform: Column | None = None) -> DataFrame:
    return df.select(
        F.col(EXP),
        (platform if platform is not None else F.col("platform")).cast("string").alias("platform"),
        F.col("feature_set").cast("string").alias("feature_set"),
        F.col("feature_count").cast("int").alias("feature_count"),
        F.col("best_model").cast("string").alias("best_model"),
        *[F.col(c).cast("double").alias(c) for c in SCORES],
        *[F.col(field).cast("double").alias(c) for c, field in costs.items()],
        F.lit(is_automl).alias("is_automl"),
        F.col("model_features"),
    )


def normalize_run_rows(
    automl_runs: DataFrame, baseline_runs: DataFrame | None = None, baseline_platform: str = "scikit-learn",
    costs: Mapping[str, str] = SECONDS,
) -> DataFrame:
    """AutoML run summaries (one row each) and baseline summaries (a
    ``models`` array each) to uniform comparison rows.  Missing fields raise
    before any job runs."""
    missing = [f for f in (*REQUIRED_RUN_FIELDS, *costs.values()) if f not in automl_runs.columns]
    if missing:
        raise ValueError(f"run summaries lack the fields {missing}")
    out = _uniform(automl_runs, True, costs)
    if baseline_runs is not None:
        if "models" not in baseline_runs.columns:
            raise ValueError("the baseline summary has no models column")
        filled = F.when(F.coalesce(F.size("models"), F.lit(0)) > 0, F.lit(True)).otherwise(
            F.raise_error(F.lit("a baseline summary lists no models")).cast("boolean"))
        models = baseline_runs.filter(filled).select(EXP, F.explode("models").alias("m")).select(
            EXP, "m.*"
        ).withColumnRenamed("model_name", "best_model")
        out = out.unionByName(_uniform(models, False, costs, F.lit(baseline_platform)))
    return out


def rank_runs(runs: DataFrame, costs: Sequence[str] = tuple(SECONDS)) -> DataFrame:
    """Five ``rank()`` columns per experiment (ties share the lowest rank).
    A NULL metric fails the query (H4)."""
    w = Window.partitionBy(EXP)
    specs = {
        "validation_rank": F.col("validation_rmse").asc(),
        "test_rmse_rank": F.col("test_rmse").asc(),
        "test_r2_rank": F.col("test_r2").desc(),
        "training_speed_rank": F.col(costs[0]).asc(),
        "prediction_speed_rank": F.col(costs[1]).asc(),
    }
    any_null = F.lit(False)
    for c in ("validation_rmse", "test_rmse", "test_r2", *costs):
        any_null = any_null | F.col(c).isNull()
    out = runs.withColumn(
        "_checked", F.when(any_null, F.raise_error(F.lit("a run lacks a metric"))).otherwise(F.lit(1))
    )
    for name, order in specs.items():
        out = out.withColumn(name, (F.rank().over(w.orderBy(order)) * F.col("_checked")).cast("int"))
    return out.drop("_checked")


def compare_to_baseline(runs: DataFrame, baseline_model: str = "RandomForestRegressor") -> DataFrame:
    """Every run against its experiment's single baseline (non-AutoML) row: percent
    change of validation RMSE, test RMSE, MAE and R^2 (R^2 change is NULL
    when the baseline R^2 is 0).  Not exactly one baseline row fails."""
    base = runs.filter((F.col("best_model") == baseline_model) & ~F.col("is_automl")).groupBy(EXP).agg(
        *[F.max(c).alias(f"_b_{c}") for c in ("validation_rmse", "test_rmse", "test_mae", "test_r2")],
        F.count(F.lit(1)).alias("_b_n"),
    )
    # a filter that raises: no choice of output columns prunes it
    single = F.when(F.coalesce(F.col("_b_n"), F.lit(0)) == 1, F.lit(True)).otherwise(
        F.raise_error(F.lit(f"an experiment needs one {baseline_model} row to compare with")).cast("boolean"))
    out = runs.join(base, EXP, "left").filter(single).select(
        *runs.columns,
        percent_change("validation_rmse", "_b_validation_rmse").alias("validation_rmse_change_vs_baseline_percent"),
        percent_change("test_rmse", "_b_test_rmse").alias("test_rmse_change_vs_baseline_percent"),
        percent_change("test_mae", "_b_test_mae").alias("test_mae_change_vs_baseline_percent"),
        percent_change("test_r2", "_b_test_r2", strict=False).alias("test_r2_change_vs_baseline_percent"),
    )
    return out


def _pair_full_reduced(runs: DataFrame, costs: Sequence[str]) -> DataFrame:
    automl = runs.filter(F.col("is_automl"))
    full = automl.filter(F.col("feature_set") == ALL_FEATURES).withColumn(
        "_full_n", F.count(F.lit(1)).over(Window.partitionBy(EXP, "platform"))
    )
    reduced = automl.filter(F.col("feature_set") == TOP_FEATURES)
    f = full.select(EXP, "platform", "_full_n", *[F.col(c).alias(f"full_{c}") for c in
                                                  ("best_model", "feature_count", *SCORES, *costs)])
    return reduced.join(f, [EXP, "platform"]).filter(F.col("_full_n") == 1).drop("_full_n")


def full_vs_reduced(runs: DataFrame, costs: Sequence[str] = tuple(SECONDS)) -> DataFrame:
    """Each reduced-feature AutoML run against the one all-features run of
    its platform (skipped unless exactly one): validation degradation and
    training-time change in percent."""
    p = _pair_full_reduced(runs, costs)
    return p.select(
        EXP, "platform", "best_model", "feature_count", "validation_rmse",
        percent_change("validation_rmse", "full_validation_rmse").alias("validation_degradation_percent"),
        percent_change(costs[0], f"full_{costs[0]}").alias("training_time_change_percent"),
    )


def compare_feature_sets(runs: DataFrame, costs: Sequence[str] = tuple(SECONDS)) -> DataFrame:
    """Top-minus-all deltas of six metrics and the validation assessment."""
    p = _pair_full_reduced(runs, costs)
    delta = F.col("validation_rmse") - F.col("full_validation_rmse")
    return p.select(
        EXP, "platform",
        F.col("full_feature_count").alias("all_features_count"),
        F.col("feature_count").alias("top_features_count"),
        F.col("full_best_model").alias("all_features_best_model"),
        F.col("best_model").alias("top_features_best_model"),
        *[(F.col(c) - F.col(f"full_{c}")).alias(f"{c}_delta_top_minus_all") for c in (*SCORES, *costs)],
        F.when(delta < 0, "improved").when(delta > 0, "degraded").otherwise("maintained").alias(
            "validation_performance_assessment"),
    )


def overlap_columns(first: str | Column, second: str | Column) -> list[Column]:
    """U3 as columns: sorted shared names, their count and the Jaccard index
    (0 for an empty union)."""
    a = F.col(first) if isinstance(first, str) else first
    b = F.col(second) if isinstance(second, str) else second
    shared = F.array_sort(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    return [
        shared.alias("shared_features"),
        F.size(shared).alias("shared_feature_count"),
        F.when(union > 0, F.size(shared) / union).otherwise(F.lit(0.0)).alias("jaccard_similarity"),
    ]


def feature_overlap(pairs: DataFrame, first: str = "first_features", second: str = "second_features") -> DataFrame:
    """U3 over a table of run pairs."""
    return pairs.select("*", *overlap_columns(first, second))


def build_recommendation(runs: DataFrame, tolerance_percent: float = 2.0, costs: Sequence[str] = tuple(SECONDS)) -> DataFrame:
    """Per experiment the best predictive AutoML run (validation RMSE,
    test RMSE, training seconds), the fastest (training seconds, validation
    RMSE) and the best reduced-feature run within ``tolerance_percent`` of its
    full run (degradation, validation RMSE, training change) or NULL.
    An experiment without AutoML rows fails."""
    automl = runs.filter(F.col("is_automl"))
    w = Window.partitionBy(EXP)
    best = automl.withColumn("_r", F.row_number().over(
        w.orderBy("validation_rmse", "test_rmse", costs[0], "platform", "feature_set"))).filter(
        F.col("_r") == 1)
    fast = automl.withColumn("_r", F.row_number().over(
        w.orderBy(costs[0], "validation_rmse", "platform", "feature_set"))).filter(F.col("_r") == 1)
    red = full_vs_reduced(runs, costs).filter(F.col("validation_degradation_percent") <= tolerance_percent)
    red = red.withColumn("_r", F.row_number().over(
        w.orderBy("validation_degradation_percent", "validation_rmse", "training_time_change_percent",
                  "platform"))).filter(F.col("_r") == 1)
    experiments = runs.groupBy(EXP).agg(F.count_if(F.col("is_automl")).alias("_automl_runs"))
    out = (
        experiments.join(best.select(EXP, *[F.col(c).alias(f"best_{c}") for c in (
            "platform", "feature_set", "feature_count", "best_model", "validation_rmse", "test_rmse", "test_mae",
            "test_r2")]), EXP, "left")
        .join(fast.select(EXP, *[F.col(c).alias(f"fastest_{c}") for c in (
            "platform", "feature_set", costs[0], "validation_rmse")]), EXP, "left")
        .join(red.select(EXP, *[F.col(c).alias(f"reduced_{c}") for c in (
            "platform", "best_model", "feature_count", "validation_rmse", "validation_degradation_percent",
            "training_time_change_percent")]), EXP, "left")
    )
    status = F.when(F.col("_automl_runs") == 0,
                    F.raise_error(F.lit("no experiment run to recommend from"))).otherwise(F.lit("PASS"))
    return out.withColumn("status", status).withColumn(
        "reduced_feature_tolerance_percent", F.lit(float(tolerance_percent))).drop("_automl_runs")
