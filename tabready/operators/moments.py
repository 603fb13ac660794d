"""Candidate search from second moments (L7): least squares and ridge over every
feature set, fitted and scored from one aggregate.

One pass gives, per experiment and split, the means of the features and the
target and the covariance of every pair.  A linear candidate needs nothing else:
its coefficients solve the train covariances (Cholesky), and its RMSE and R^2 on
any split are quadratic forms of that split's moments.  So thousands of candidates
cost one scan, one row per experiment and split goes on, and the solving is spread
over the experiments.  Predictions are made for the chosen candidates only, all of
them in one pass.

Second-order terms are features like others: ``with_products`` adds the product of
each pair (a factorisation machine's interactions, each with its own weight).
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabready.functions.arithmetic import round_metric
from tabready.operators.joins import join_small

CANDIDATE = ("experiment_id string, model string, features array<string>, ridge double, feature_count int, intercept double, "
             "weights array<double>, train_rmse double, validation_rmse double, test_rmse double, validation_r2 double, test_r2 double")
SPLITS = ("train", "validation", "test")
#: A pivot of the scaled covariance below this is a feature that the others give.
LEAST_PIVOT = 1e-10


@dataclass(frozen=True)
class SearchSpace:
    """All feature sets of the given sizes, each with every ridge penalty (on
    features scaled to unit variance)."""

    features: tuple[str, ...]
    sizes: tuple[int, ...] = (1, 2)
    ridges: tuple[float, ...] = (0.0,)

    def candidates(self) -> Iterator[tuple[str, tuple[int, ...], float]]:
        for size in self.sizes:
            for chosen in itertools.combinations(range(len(self.features)), size):
                for ridge in self.ridges:
                    name = "+".join(self.features[i] for i in chosen)
                    yield (f"ridge_{ridge:g}:{name}" if ridge else f"ols:{name}"), chosen, ridge


def with_products(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The frame with the product of every two features, and all names."""
    pairs = {f"{a}*{b}": F.col(a) * F.col(b) for a, b in itertools.combinations(features, 2)}
    return df.withColumns(pairs), [*features, *pairs]


def split_moments(df: DataFrame, features: Sequence[str], target: str, experiment: str, split_col: str = "data_split") -> DataFrame:
    """One row per experiment and split: ``n``, the means and the covariances of
    (features..., target), the upper triangle row by row.  Rows that lack any of
    them are left out and counted as ``incomplete``."""
    cols = [F.col(f"`{c}`").cast("double") for c in (*features, target)]
    names = [f"_{i}" for i in range(len(cols))]
    whole = F.lit(True)
    for c in names:
        whole = whole & F.col(c).isNotNull() & ~F.isnan(c)
    narrow = df.select(F.col(experiment).cast("string").alias("experiment_id"), F.col(split_col).alias("data_split"),
                       *[c.alias(n) for c, n in zip(cols, names)]).withColumn("_whole", whole)
    own = lambda c: F.when(F.col("_whole"), F.col(c))
    return narrow.where("experiment_id IS NOT NULL").groupBy("experiment_id", "data_split").agg(
        F.count_if("_whole").alias("n"), F.count_if(~F.col("_whole")).alias("incomplete"),
        F.array(*[F.avg(own(c)) for c in names]).alias("means"),
        F.array(*[F.covar_pop(own(a), own(b)) for a, b in itertools.combinations_with_replacement(names, 2)]).alias("covariances"))


def feature_correlations(moments: DataFrame, features: Sequence[str]) -> DataFrame:
    """``experiment_id, data_split, feature, correlation`` with the target; null
    for a feature or target that doesn't vary."""
    k = len(features) + 1
    at = lambda i, j: F.col("covariances")[i * k - i * (i - 1) // 2 + j - i]
    spread = lambda i: F.when(at(i, i) > 0, F.sqrt(at(i, i) * at(k - 1, k - 1)))
    cells = [F.struct(F.lit(f).alias("feature"), (at(i, k - 1) / F.when(spread(i) > 0, spread(i))).alias("correlation")) for i, f in enumerate(features)]
    return moments.select("experiment_id", "data_split", F.explode(F.array(*cells)).alias("_c")).select("experiment_id", "data_split", "_c.*")


def solve(means: np.ndarray, cov: np.ndarray, chosen: Sequence[int], ridge: float) -> tuple[float, np.ndarray] | None:
    """Intercept and weights of a feature set, or None if its features don't
    determine them (a constant, or one that others give exactly)."""
    at, y = list(chosen), len(means) - 1
    scale = np.sqrt(np.diag(cov)[at])
    if not (scale > 0).all():
        return None
    corr = cov[np.ix_(at, at)] / np.outer(scale, scale) + ridge * np.eye(len(at))
    try:
        lower = np.linalg.cholesky(corr)
    except np.linalg.LinAlgError:
        return None
    if (np.diag(lower) ** 2).min() < LEAST_PIVOT:
        return None
    half = np.linalg.solve(lower, cov[at, y] / scale)
    weights = np.linalg.solve(lower.T, half) / scale
    return float(means[y] - weights @ means[at]), weights


def errors(means: np.ndarray, cov: np.ndarray, chosen: Sequence[int], intercept: float, weights: np.ndarray) -> tuple[float, float]:
    """RMSE and R^2 of a candidate on the split with these moments."""
    at, y = list(chosen), len(means) - 1
    bias = means[y] - intercept - weights @ means[at]
    spread = cov[y, y] - 2 * weights @ cov[at, y] + weights @ cov[np.ix_(at, at)] @ weights
    mse = max(0.0, spread) + bias * bias
    return float(np.sqrt(mse)), float(1 - mse / cov[y, y]) if cov[y, y] > 0 else (1.0 if mse == 0 else 0.0)


def _square(means: Sequence[float], upper: Sequence[float]) -> tuple[np.ndarray, np.ndarray]:
    k = len(means)
    cov = np.zeros((k, k))
    cov[np.triu_indices(k)] = upper
    return np.array(means, float), cov + np.triu(cov, 1).T


def search(moments: DataFrame, space: SearchSpace) -> DataFrame:
    """Every candidate of every experiment, with its coefficients and its
    errors on all splits; candidates without a solution, and experiments without
    train rows, are left out.  A split without rows has null errors."""
    sides = [F.max(F.when(F.col("data_split") == s, F.struct("n", "means", "covariances"))).alias(s) for s in SPLITS]
    rows = moments.where("n > 0").groupBy("experiment_id").agg(*sides).where("train IS NOT NULL")
    features = space.features

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                sides = {s: _square(v["means"], v["covariances"]) for s in SPLITS if (v := getattr(r, s)) is not None}
                out = []
                for name, chosen, ridge in space.candidates():
                    if (fit := solve(*sides["train"], chosen, ridge)) is None:
                        continue
                    e = {s: errors(*m, chosen, *fit) for s, m in sides.items()}
                    none = (None, None)
                    out.append((r.experiment_id, name, [features[i] for i in chosen], ridge, len(chosen), fit[0], fit[1].tolist(),
                                e["train"][0], e.get("validation", none)[0], e.get("test", none)[0],
                                e.get("validation", none)[1], e.get("test", none)[1]))
                yield pd.DataFrame(out, columns=[c.split()[0] for c in CANDIDATE.split(", ")])

    return rows.mapInPandas(run, CANDIDATE)


def rounded(candidates: DataFrame) -> DataFrame:
    return candidates.withColumns({c: round_metric(c) for c in candidates.columns if c.endswith(("_rmse", "_r2"))})


def predict_candidates(df: DataFrame, candidates: DataFrame, identifier: str, target: str, experiment: str,
                       split_col: str = "data_split") -> DataFrame:
    """The long predictions table of chosen candidates, in one pass over the rows:
    ``experiment_id, model, row_id, data_split, actual, predicted``.  A row that
    lacks a feature of a candidate has no prediction by it."""
    features = sorted({f for r in candidates.select("features").distinct().collect() for f in r["features"]})
    values = F.create_map(*[x for f in features for x in (F.lit(f), F.col(f"`{f}`").cast("double"))])
    rows = df.select(F.col(experiment).cast("string").alias("experiment_id"), F.col(identifier).alias("row_id"),
                     F.col(split_col).alias("data_split"), F.col(target).cast("double").alias("actual"), values.alias("_x"))
    chosen = candidates.groupBy("experiment_id").agg(F.collect_list(F.struct("model", "features", "intercept", "weights")).alias("_models"))
    each = join_small(rows, chosen, ["experiment_id"]).select("*", F.explode("_models").alias("_m"))
    terms = F.zip_with("_m.features", "_m.weights", lambda f, w: F.col("_x")[f] * w)
    predicted = F.aggregate(terms, F.col("_m.intercept"), lambda total, t: total + t)
    return each.select("experiment_id", "_m.model", "row_id", "data_split", "actual", predicted.alias("predicted")).where("predicted IS NOT NULL")
