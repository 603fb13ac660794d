"""Closed-form candidate regressors fit with Spark aggregates (L5 and the
SQL-checkable candidates of SURVEY 7.4).

A candidate is fit on the train rows and scores every row, so the output of a
search is one long predictions table ``(model, id, data_split, actual,
predicted)`` -- metrics, leaderboards, blends and importance are then grouped
jobs over that table (SURVEY 4.3 item 4).

All fits come from one aggregate over the train rows.  Global fits enter the
scoring pass as literals; per-key fits (one row per key value) are counted and
broadcast, so that no row is hashed on a few hot keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabready.operators.joins import join_small
from tabready.session import ensure_checkpoint_dir

# fit(train, target) -> scorer(df) -> Column of predictions
Scorer = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Candidate:
    """A named closed-form model over ``features``.

    ``kind``: ``mean`` (L5), ``group_mean`` (mean of the target per key, global
    mean for unseen keys), ``ols`` (least squares on one numeric feature) or
    ``group_ols`` (least squares per key, global fit for unseen keys).
    """

    name: str
    kind: str
    features: tuple[str, ...] = ()
    key: str | None = None  # SQL expression of the grouping key


def _train(df: DataFrame, split_col: str, train_label: str) -> DataFrame:
    return df.filter(F.col(split_col) == train_label)


def fit_candidate(train: DataFrame, cand: Candidate, target: str) -> Scorer:
    """Fit ``cand`` on ``train``; the returned function adds ``predicted`` to any frame."""
    y = F.col(target)
    key = F.expr(cand.key) if cand.key else None
    global_mean = train.agg(F.avg(y)).scalar()
    if cand.kind == "mean":
        return lambda df: df.withColumn("predicted", global_mean)
    if cand.kind == "group_mean":
        ensure_checkpoint_dir(train.sparkSession)
        fitted = train.groupBy(key.alias("_key")).agg(F.avg(y).alias("_group_mean")).checkpoint(eager=True)

        def score(df: DataFrame) -> DataFrame:
            scored = join_small(df.withColumn("_key", key), fitted, ["_key"], "left")
            return scored.withColumn("predicted", F.coalesce(F.col("_group_mean"), global_mean)).drop(
                "_key", "_group_mean")
        return score
    x = F.col(cand.features[-1])
    g_slope = train.agg(F.regr_slope(y, x)).scalar()
    g_intercept = train.agg(F.regr_intercept(y, x)).scalar()
    if cand.kind == "ols":
        return lambda df: df.withColumn("predicted", g_intercept + g_slope * x)
    if cand.kind == "group_ols":
        ensure_checkpoint_dir(train.sparkSession)
        fitted = train.groupBy(key.alias("_key")).agg(
            F.regr_slope(y, x).alias("_slope"), F.regr_intercept(y, x).alias("_intercept")).checkpoint(eager=True)

        def score(df: DataFrame) -> DataFrame:
            scored = join_small(df.withColumn("_key", key), fitted, ["_key"], "left")
            pred = F.when(F.col("_slope").isNotNull(), F.col("_intercept") + F.col("_slope") * x).otherwise(
                g_intercept + g_slope * x)
            return scored.withColumn("predicted", pred).drop("_key", "_slope", "_intercept")
        return score
    raise ValueError(f"unknown candidate kind {cand.kind}")


def score_candidate(
    df: DataFrame, cand: Candidate, target: str, split_col: str = "data_split", train_label: str = "train"
) -> DataFrame:
    """Fit ``cand`` on the train rows of ``df`` and add ``predicted`` to every row."""
    return fit_candidate(_train(df, split_col, train_label), cand, target)(df)


def fit_table(train: DataFrame, candidates: Sequence[Candidate], target: str) -> DataFrame:
    """Every fit of every candidate from one pass over ``train``: a row per
    (key expression, key value), and one with a NULL key expression for the
    global fits, with the target's mean and a least-squares line per feature."""
    y = F.col(target)
    xs = sorted({c.features[-1] for c in candidates if c.kind in ("ols", "group_ols")})
    keys = sorted({c.key for c in candidates if c.key})
    cells = [F.struct(F.lit(None).cast("string").alias("_by"), F.lit(None).cast("string").alias("_key"))]
    cells += [F.struct(F.lit(k).alias("_by"), F.expr(k).cast("string").alias("_key")) for k in keys]
    long = train.select(y.alias("_y"), *[F.col(x).alias(f"_x{i}") for i, x in enumerate(xs)],
                        F.explode(F.array(*cells)).alias("_c")).select("*", "_c.*")
    aggs = [F.avg("_y").alias("_mean")]
    for i in range(len(xs)):
        aggs += [F.regr_slope("_y", f"_x{i}").alias(f"_slope_{xs[i]}"), F.regr_intercept("_y", f"_x{i}").alias(f"_intercept_{xs[i]}")]
    # a key value of NULL fits nothing; the global row has no key expression
    return long.filter(F.col("_by").isNull() | F.col("_key").isNotNull()).groupBy("_by", "_key").agg(*aggs)


def candidate_predictions(
    df: DataFrame,
    candidates: Sequence[Candidate],
    identifier: str,
    target: str,
    split_col: str = "data_split",
    train_label: str = "train",
    keep: Sequence[str] = (),
) -> DataFrame:
    """All candidates' predictions on all splits as one long table, with the
    columns of ``keep``.

    One pass over the train rows fits everything, one pass over all rows scores
    all candidates side by side and unpivots them.  The fits (a row per key
    value) are counted and broadcast; more of them than that allows are joined.
    """
    ensure_checkpoint_dir(df.sparkSession)
    fits = fit_table(_train(df, split_col, train_label), candidates, target).checkpoint(eager=True)
    whole = fits.filter(F.col("_by").isNull()).first()
    at = whole.asDict() if whole is not None else {}
    number = lambda name: F.lit(at.get(name)).cast("double")
    wide = df
    keys = sorted({c.key for c in candidates if c.key})
    for k, key in enumerate(keys):
        own = fits.filter(F.col("_by") == key).drop("_by")
        own = own.select(F.col("_key").alias(f"_key{k}"), *[F.col(c).alias(f"{c}@{k}") for c in own.columns if c != "_key"])
        wide = join_small(wide.withColumn(f"_key{k}", F.expr(key).cast("string")), own, [f"_key{k}"], "left")

    def predicted(c: Candidate):
        if c.kind in ("mean", "group_mean"):
            return F.coalesce(F.col(f"`_mean@{keys.index(c.key)}`"), number("_mean")) if c.key else number("_mean")
        x = c.features[-1]
        line = number(f"_intercept_{x}") + number(f"_slope_{x}") * F.col(x)
        if not c.key:
            return line
        k = keys.index(c.key)
        slope = F.col(f"`_slope_{x}@{k}`")
        return F.when(slope.isNotNull(), F.col(f"`_intercept_{x}@{k}`") + slope * F.col(x)).otherwise(line)

    cells = [F.struct(F.lit(c.name).alias("model"), predicted(c).alias("predicted")) for c in candidates]
    return wide.select(F.explode(F.array(*cells)).alias("_p"), F.col(identifier).alias("row_id"), F.col(split_col).alias("data_split"),
                       F.col(target).alias("actual"), *keep).select("_p.model", "row_id", "data_split", "actual", "_p.predicted", *keep)


def candidate_costs(
    df: DataFrame, candidates: Sequence[Candidate], split_col: str = "data_split", train_label: str = "train"
) -> DataFrame:
    """Deterministic costs per candidate: ``fit_cells``, the cells that its fit
    reads (train rows x features and target), and ``predict_cells_per_row``, the
    cells that a prediction reads.  They rank models by work where seconds would
    differ from run to run; ``cost.measured_costs`` times the passes.
    """
    n_train = _train(df, split_col, train_label).agg(F.count(F.lit(1))).scalar()
    meta = df.sparkSession.createDataFrame([(c.name, len(c.features)) for c in candidates], "model string, feature_count int")
    return meta.select("model", "feature_count", (n_train * (F.col("feature_count") + 1)).cast("long").alias("fit_cells"),
                       F.col("feature_count").alias("predict_cells_per_row"))
