"""Regression metrics over prediction tables.

Metrics are grouped aggregates over the long predictions table, so every
model and split is scored in one job with map-side partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabready.functions.arithmetic import residual, round_metric
from tabready.operators.joins import join_small
from tabready.session import ensure_checkpoint_dir


def regression_metrics(
    preds: DataFrame, by: Sequence[str] = ("model", "data_split"), actual: str = "actual",
    predicted: str = "predicted", digits: int | None = 6,
) -> DataFrame:
    """Rows, RMSE, MAE and R^2 per group.

    R^2 = 1 - SSE / SST with SST = n * var_pop(actual); a constant target
    gives 1.0 when every error is 0, else 0.0 (H8).  Rows missing either side
    raise, like the reference's length check.
    """
    e = residual(actual, predicted)
    checked = F.when(F.col(actual).isNull() | F.col(predicted).isNull(),
                     F.raise_error(F.lit("a prediction row lacks its actual or predicted value"))).otherwise(e)
    agg = preds.groupBy(*by).agg(
        F.count(checked).alias("rows"),
        F.sum(checked * checked).alias("_sse"),
        F.avg(F.abs(checked)).alias("_mae"),
        F.var_pop(F.when(checked.isNotNull(), F.col(actual))).alias("_var"),
    )
    sst = F.col("_var") * F.col("rows")
    r2 = F.when(sst > 0, 1 - F.col("_sse") / sst).when(F.col("_sse") == 0, 1.0).otherwise(0.0)
    rnd = (lambda c: round_metric(c, digits)) if digits is not None else (lambda c: c)
    return agg.select(
        *by,
        "rows",
        rnd(F.sqrt(F.col("_sse") / F.col("rows"))).alias("rmse"),
        rnd(F.col("_mae")).alias("mae"),
        rnd(r2).alias("r2"),
    )


def model_validation_table(
    preds: DataFrame, costs: DataFrame, validation_label: str = "validation", test_label: str = "test",
    by: Sequence[str] = (),
) -> DataFrame:
    """Per model (of each ``by``) validation and test RMSE/MAE/R^2 next to
    what its fit and predictions cost (the leaderboard)."""
    m = regression_metrics(preds.filter(F.col("data_split").isin(validation_label, test_label)), [*by, "model", "data_split"])
    wide = m.groupBy(*by, "model").agg(
        *[F.max(F.when(F.col("data_split") == s, F.col(c))).alias(f"{p}_{c}")
          for s, p in ((validation_label, "validation"), (test_label, "test")) for c in ("rmse", "mae", "r2")]
    )
    return wide.join(costs, "model", "left")


def align_sample_target(sample: DataFrame, rows: DataFrame, identifier: str, target: str) -> DataFrame:
    """The target of every sampled row, by identifier; the sample's rows
    and columns stay."""
    return sample.join(rows.select(identifier, target), identifier, "left")


def align_predictions(actuals: DataFrame, predictions: DataFrame, identifier: str) -> DataFrame:
    """Actual and predicted values matched by identifier (Spark has no
    positional alignment).  Unmatched rows on either side surface as NULLs,
    which ``regression_metrics`` rejects."""
    return actuals.join(predictions, identifier, "full_outer")


def add_residual(preds: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """P14."""
    return preds.withColumn("residual", residual(actual, predicted))


def actual_vs_predicted_grid(
    preds: DataFrame, bins: int = 20, by: Sequence[str] = ("model",), actual: str = "actual",
    predicted: str = "predicted",
) -> DataFrame:
    """2-D bin counts of actual vs predicted over the joint min/max of
    both axes per group (the scatter plot with its identity line, as data
    that scales)."""
    bounds = preds.groupBy(*by).agg(
        F.least(F.min(actual), F.min(predicted)).alias("lo"),
        F.greatest(F.max(actual), F.max(predicted)).alias("hi"),
    )
    ensure_checkpoint_dir(preds.sparkSession)
    bounds = bounds.checkpoint(eager=True)
    width = (F.col("hi") - F.col("lo")) / bins

    def bin_of(c):
        raw = F.when(width > 0, F.floor((F.col(c) - F.col("lo")) / width)).otherwise(F.lit(0))
        return F.least(raw, F.lit(bins - 1)).cast("int")

    return (
        join_small(preds, bounds, by)
        .groupBy(*by, "lo", "hi", bin_of(actual).alias("actual_bin"), bin_of(predicted).alias("predicted_bin"))
        .agg(F.count(F.lit(1)).alias("points"))
        .withColumn("lo", round_metric("lo"))
        .withColumn("hi", round_metric("hi"))
    )
