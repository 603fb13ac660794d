"""Leaderboards, rankings and top-k.

Every window is partitioned by run (or experiment); ``row_number() <= k``
filters become ``WindowGroupLimit`` so only k rows per run and map task are
shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabready.functions.arithmetic import negated_score_to_error


def _w(by: Sequence[str]):
    return Window.partitionBy(*[F.col(c) for c in by]) if by else Window.partitionBy(F.lit(0))


def normalize_score_leaderboard(lb: DataFrame) -> DataFrame:
    """Higher-is-better ``score_val`` / ``score_test`` to positive RMSE columns."""
    if "model" not in lb.columns:
        raise ValueError("a leaderboard needs a model column")
    out = lb
    if "score_val" in lb.columns:
        out = out.withColumn("validation_rmse", negated_score_to_error("score_val"))
    if "score_test" in lb.columns:
        out = out.withColumn("test_rmse", negated_score_to_error("score_test"))
    if "validation_rmse" not in out.columns:
        raise ValueError("a leaderboard needs a score_val column")
    return out


def rank_leaderboard(
    lb: DataFrame, score: str = "validation_rmse", name: str = "model", by: Sequence[str] = (),
    rank_col: str = "validation_rank",
) -> DataFrame:
    """Number models 1..n by ``(score, name)`` per run; NULL scores last.
    A run without a single numeric score fails the query."""
    s = F.col(score).try_cast("double")
    w = _w(by)
    numeric = F.count(s).over(w)
    rank = F.row_number().over(w.orderBy(s.asc_nulls_last(), F.col(name)))
    return lb.withColumn(score, s).withColumn(
        rank_col,
        F.when(numeric == 0, F.raise_error(F.lit("no leaderboard row has a number as its score"))).otherwise(rank),
    )


def top_models_by_score(
    lb: DataFrame, k: int = 3, score: str = "validation_rmse", name: str = "model", by: Sequence[str] = ()
) -> DataFrame:
    """The k best models per run by ``(score, name)``."""
    rank = F.row_number().over(_w(by).orderBy(F.col(score).asc_nulls_last(), F.col(name)))
    return lb.withColumn("score_rank", rank).filter(F.col("score_rank") <= k)


def select_speed_column(columns: Sequence[str], options: Sequence[str] = ("fit_time_marginal", "fit_time")) -> str:
    """First timing column present."""
    for c in options:
        if c in columns:
            return c
    raise ValueError("no column of the leaderboard holds fit times")


def top_models_by_speed(
    lb: DataFrame, k: int = 3, time_col: str | None = None, score: str = "validation_rmse", name: str = "model",
    by: Sequence[str] = (), rank_col: str = "speed_rank",
) -> DataFrame:
    """Drop rows without timing (F17), order by ``(time, score, name)``."""
    time_col = time_col or select_speed_column(lb.columns)
    t = F.col(time_col).try_cast("double")
    rank = F.row_number().over(_w(by).orderBy(t, F.col(score).asc_nulls_last(), F.col(name)))
    return (
        lb.withColumn(time_col, t)
        .filter(F.col(time_col).isNotNull())
        .withColumn(rank_col, rank)
        .filter(F.col(rank_col) <= k)
    )


def top_models_by_training_speed(lb: DataFrame, k: int = 3, **kw) -> DataFrame:
    """W5."""
    return top_models_by_speed(lb, k, **kw)


def top_models_by_prediction_speed(lb: DataFrame, k: int = 3, time_col: str = "predict_time_per_row_ms",
                                   **kw) -> DataFrame:
    """W6."""
    return top_models_by_speed(lb, k, time_col=time_col, rank_col="prediction_speed_rank", **kw)


IMPORTANCE_COLUMNS = ("relative_importance", "scaled_importance", "percentage")


def rank_importance(imp: DataFrame, by: Sequence[str] = (), feature: str | None = None) -> DataFrame:
    """Normalise the feature-name column, take the first supported
    importance column, cast, drop missing values, rank descending."""
    feature = feature or ("variable" if "variable" in imp.columns else imp.columns[0])
    col = next((c for c in IMPORTANCE_COLUMNS if c in imp.columns), None)
    if col is None:
        raise ValueError("the table has no importance column that is known here")
    v = F.col(col).try_cast("double")
    out = imp.withColumn("variable", F.trim(F.col(feature).cast("string"))).withColumn(col, v).filter(
        F.col(col).isNotNull()
    )
    rank = F.row_number().over(_w(by).orderBy(F.col(col).desc(), F.col("variable")))
    return out.withColumn("importance_rank", rank)


def scaled_importance(imp: DataFrame, value: str = "relative_importance", by: Sequence[str] = ()) -> DataFrame:
    """``scaled = value / max``, ``percentage = value / sum`` per run."""
    w = _w(by)
    return imp.withColumn("scaled_importance", F.col(value) / F.max(value).over(w)).withColumn(
        "percentage", F.col(value) / F.sum(value).over(w)
    )


def top_features(
    ranked: DataFrame, k: int = 3, by: Sequence[str] = (), feature: str = "feature",
    rank: str = "importance_rank",
) -> DataFrame:
    """First k unique, trimmed, non-empty feature names per run by rank,
    as an ordered array; a run with fewer than k fails the query."""
    names = ranked.select(*by, F.trim(F.col(feature).cast("string")).alias("_f"), F.col(rank).alias("_r")).filter(
        F.length("_f") > 0
    )
    first = names.groupBy(*by, "_f").agg(F.min("_r").alias("_r"))
    picked = first.withColumn("_n", F.row_number().over(_w(by).orderBy("_r", "_f"))).filter(F.col("_n") <= k)
    agg = picked.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_n", "_f"))).alias("_s"))
    feats = F.transform("_s", lambda s: s["_f"])
    out = agg.select(*by, feats.alias("top_features"))
    return out.withColumn(
        "top_features",
        F.when(F.size("top_features") != k,
               F.raise_error(F.concat(F.lit(f"{k} top features are asked for, found "),
                                      F.size("top_features").cast("string"), F.lit("")))).otherwise(
            F.col("top_features")),
    )
