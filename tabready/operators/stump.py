"""One-level regression trees from histogram aggregates, and importances of the
best-ranked model that has them (L11).

Every feature's values fall into at most ``bins`` cells of equal width between
its least and largest value.  One aggregate per (feature, cell) gives count, sum and sum of squares; running sums
over the cells give the variance that each cut removes.  The window of a feature
holds its cells only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabready.operators.joins import join_small


def feature_cells(train: DataFrame, features: Sequence[str], target: str, experiment: str, bins: int = 32) -> DataFrame:
    """``experiment_id, feature, cell, n, total, squares`` of every non-empty cell;
    rows without a target, and missing values of a feature, are left out."""
    rows = train.select(F.col(experiment).cast("string").alias("experiment_id"), F.col(target).cast("double").alias("_y"),
                        *[F.col(f).cast("double").alias(f) for f in features])
    rows = rows.where("_y IS NOT NULL AND NOT isnan(_y) AND experiment_id IS NOT NULL")
    known = lambda f: F.when(~F.isnan(f), F.col(f))
    ends = rows.groupBy("experiment_id").agg(*[x for f in features for x in (F.min(known(f)).alias(f"_lo_{f}"), F.max(known(f)).alias(f"_hi_{f}"))])

    def cell(f: str) -> Column:
        lo, hi = F.col(f"_lo_{f}"), F.col(f"_hi_{f}")
        at = F.when(hi > lo, F.least(F.floor((F.col(f) - lo) / (hi - lo) * bins), F.lit(bins - 1))).otherwise(0)
        return F.struct(F.lit(f).alias("feature"), F.when(F.col(f).isNotNull() & ~F.isnan(f), at.cast("int")).alias("cell"))

    long = join_small(rows, ends.checkpoint(eager=True), ["experiment_id"]).select(
        "experiment_id", "_y", F.explode(F.array(*map(cell, features))).alias("_c"))
    return long.where("_c.cell IS NOT NULL").groupBy("experiment_id", "_c.feature", "_c.cell").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_y").alias("total"), F.sum(F.col("_y") * F.col("_y")).alias("squares"))


def best_cuts(cells: DataFrame) -> DataFrame:
    """Per experiment and feature the cut that removes most variance:
    ``experiment_id, feature, cut_cell`` (cells up to it go left), ``gain`` (the
    sum of squares removed), ``left_mean, right_mean``.  Among equal gains the
    first cut; a feature of one cell has no cut and no gain."""
    by = Window.partitionBy("experiment_id", "feature")
    left = by.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = cells.select("experiment_id", "feature", "cell", F.sum("n").over(left).alias("n1"), F.sum("total").over(left).alias("s1"),
                        F.sum("n").over(by).alias("n"), F.sum("total").over(by).alias("s"))
    n2, s2 = F.col("n") - F.col("n1"), F.col("s") - F.col("s1")
    # squares cancel: what a cut removes is n1 n2 / n times the squared difference of the means
    difference = F.col("s1") / F.col("n1") - s2 / F.when(n2 > 0, n2)
    gain = F.when(n2 > 0, F.col("n1") * n2 / F.col("n") * difference * difference)
    scored = sums.select("experiment_id", "feature", "cell", F.round(gain, 4).alias("gain"), (F.col("s1") / F.col("n1")).alias("left_mean"),
                         (s2 / F.when(n2 > 0, n2)).alias("right_mean")).where("gain IS NOT NULL")
    first = F.row_number().over(by.orderBy(F.desc("gain"), "cell"))
    return scored.withColumn("_r", first).where("_r = 1").select(
        "experiment_id", "feature", F.col("cell").alias("cut_cell"), "gain", "left_mean", "right_mean")


def fit_stumps(cuts: DataFrame) -> DataFrame:
    """The tree of each experiment: its best feature's cut (ties by name)."""
    best = F.row_number().over(Window.partitionBy("experiment_id").orderBy(F.desc("gain"), "feature"))
    return cuts.withColumn("_r", best).where("_r = 1").drop("_r")


def stump_importance(cuts: DataFrame, features: Sequence[str]) -> DataFrame:
    """``experiment_id, variable, relative_importance``: the variance that the
    best cut of each feature removes; 0 for a feature without a cut."""
    every = cuts.select("experiment_id").distinct().select("experiment_id", F.explode(F.array(*map(F.lit, features))).alias("feature"))
    return every.join(cuts, ["experiment_id", "feature"], "left").select(
        "experiment_id", F.col("feature").alias("variable"), F.coalesce("gain", F.lit(0.0)).alias("relative_importance"))


@dataclass(frozen=True)
class RankedModel:
    """A model of a leaderboard and its importances (``experiment_id, variable,
    relative_importance``), or None if it has none."""

    name: str
    importance: DataFrame | None = None


def best_model_importance(leaderboard: DataFrame, models: Sequence[RankedModel], max_models: int = 5, score: str = "validation_rmse") -> DataFrame:
    """L11 for every experiment: importances of the best-ranked of its first
    ``max_models`` models that has them.  An experiment without one fails, with
    the names of the models that were looked at."""
    order = F.row_number().over(Window.partitionBy("experiment_id").orderBy(F.col(score).asc_nulls_last(), "model"))
    looked = leaderboard.select("experiment_id", "model", order.alias("_r")).where(F.col("_r") <= max_models)
    having = [m.name for m in models if m.importance is not None]
    owner = looked.groupBy("experiment_id").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("_r", "model")))["model"], ", ").alias("_checked"),
        F.min_by("model", F.when(F.col("model").isin(*having), F.col("_r"))).alias("model"))
    sure = F.when(F.col("model").isNotNull(), F.lit(True)).otherwise(F.raise_error(F.concat(
        F.lit("no model with importances in "), "experiment_id", F.lit("; checked: "), "_checked")).cast("boolean"))
    owner = owner.filter(sure).select("experiment_id", "model")
    out = None
    for m in models:
        if m.importance is not None:
            own = m.importance.select("experiment_id", "variable", "relative_importance").withColumn("model", F.lit(m.name))
            out = own if out is None else out.unionByName(own)
    if out is None:
        return owner.select("experiment_id", "model", F.lit(None).cast("string").alias("variable"), F.lit(None).cast("double").alias("relative_importance"))
    # the owners stay when no importance row matches, so that the check runs for every experiment
    return owner.join(out, ["experiment_id", "model"], "left").select("experiment_id", "model", "variable", "relative_importance")

