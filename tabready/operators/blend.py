"""Greedy weighted blends of every experiment at once.

The validation errors of an experiment's models give a k x k matrix of mean
products.  Selection with replacement is a fold over that matrix in an array
column: a blend with counts c has the squared error c'Gc / n^2, so the model to
add next is the one with the least 2 (Gc)_i + G_ii.  Nothing but that matrix is
shuffled after the errors, and no experiment waits for another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXP = "experiment_id"
BLEND = "WeightedEnsemble"
#: Digits of the scaled scores that are compared: equal models tie, and the one
#: first by name is taken, whatever the order of sums.
SCORE_DIGITS = 9


def error_matrices(preds: DataFrame, models: Sequence[str], split_label: str = "validation") -> DataFrame:
    """``experiment_id, models, gram``: the mean products of the errors of the
    models, in the order given, over the rows of the split.  A model that has no
    prediction for some row of its experiment has nulls in its row and column."""
    models = list(models)
    error = F.col("actual") - F.col("predicted")
    twice = F.raise_error(F.lit("a row is predicted twice by one model")).cast("double")
    own = [F.when(F.count_if(F.col("model") == m) > 1, twice).otherwise(F.max(F.when(F.col("model") == m, error))).alias(f"_{i}")
           for i, m in enumerate(models)]
    wide = preds.where((F.col("data_split") == split_label) & F.col("model").isin(*models)).groupBy(EXP, "row_id").agg(*own)
    k = len(models)
    whole = [F.count_if(F.col(f"_{i}").isNull()).alias(f"_missing{i}") for i in range(k)]
    sums = [F.avg(F.col(f"_{i}") * F.col(f"_{j}")).alias(f"_g{i}_{j}") for i in range(k) for j in range(i, k)]
    row = wide.groupBy(EXP).agg(*whole, *sums)
    cell = lambda i, j: F.when((F.col(f"_missing{i}") == 0) & (F.col(f"_missing{j}") == 0), F.col(f"_g{min(i, j)}_{max(i, j)}"))
    return row.select(EXP, F.array(*map(F.lit, models)).alias("models"),
                      F.array(*[F.array(*[cell(i, j) for j in range(k)]) for i in range(k)]).alias("gram"))


def greedy_counts(gram: Column, rounds: int = 25) -> Column:
    """How often each model is taken in ``rounds`` steps, as an array column."""
    zeros = F.transform(gram, lambda _: F.lit(0))
    scale = F.array_max(F.transform(gram, lambda row, i: F.get(row, i)))

    def step(counts: Column, _: Column) -> Column:
        dot = lambda row: F.aggregate(F.zip_with(row, counts, lambda g, n: F.coalesce(g, F.lit(0.0)) * n), F.lit(0.0), lambda s, x: s + x)
        scores = F.transform(gram, lambda row, i: F.round((2 * dot(row) + F.get(row, i)) / F.when(scale > 0, scale).otherwise(1.0), SCORE_DIGITS))
        # folds over one element: they give the scores, and the best position, a name each
        best = F.aggregate(F.array(scores), F.lit(0).cast("long"), lambda _, s: F.array_position(s, F.array_min(s)))
        return F.aggregate(F.array(best), counts, lambda c, at: F.transform(c, lambda n, i: n + F.when(i + 1 == at, 1).otherwise(0)))

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), zeros, step)


def blend_weights(matrices: DataFrame, rounds: int = 25) -> DataFrame:
    """``experiment_id, model, weight`` of every model that is taken."""
    counts = matrices.select(EXP, "models", greedy_counts(F.col("gram"), rounds).alias("counts"))
    each = counts.select(EXP, F.explode(F.arrays_zip("models", "counts")).alias("_z"))
    return each.where("_z.counts > 0").select(EXP, F.col("_z.models").alias("model"), (F.col("_z.counts") / float(rounds)).alias("weight"))


def blended(preds: DataFrame, weights: DataFrame, name: str = BLEND) -> DataFrame:
    """The blend's predictions, ``experiment_id, model, row_id, data_split, actual, predicted``."""
    return (preds.join(F.broadcast(weights), [EXP, "model"]).groupBy(EXP, "row_id", "data_split")
            .agg(F.max("actual").alias("actual"), F.sum(F.col("weight") * F.col("predicted")).alias("predicted"))
            .select(EXP, F.lit(name).alias("model"), "row_id", "data_split", "actual", "predicted"))


def blend_costs(weights: DataFrame, costs: DataFrame, cost: str, marginal: DataFrame, name: str = BLEND) -> DataFrame:
    """``experiment_id, model, <cost>_marginal, <cost>_total`` of the base models
    and of the blend: a base model's total is its own; the blend's marginal is
    what choosing it took (``marginal``: experiment_id, <cost>), its total adds
    the base models that it holds (H12)."""
    base = costs.select(EXP, "model", F.col(cost).alias(f"{cost}_marginal"), F.col(cost).alias(f"{cost}_total"))
    held = weights.join(costs, [EXP, "model"]).groupBy(EXP).agg(F.sum(cost).alias("_held"))
    own = marginal.join(held, EXP).select(EXP, F.lit(name).alias("model"), F.col(cost).alias(f"{cost}_marginal"),
                                          (F.col(cost) + F.col("_held")).alias(f"{cost}_total"))
    return base.unionByName(own)
