"""Feature importance (L10 permutation importance, L11 model importance).

Permutation importance is one Spark job over the whole frame: rows are exploded
to (feature, repeat) copies; in each copy the feature's values are permuted by
joining every row to the donor row whose hash rank equals its own position (an
equi-join on rank, partitioned by feature and repeat); all copies are scored in
a single pass and the RMSE increase is aggregated per (feature, repeat), then
per feature.  Ranks come from hash buckets: a window numbers the rows of one
bucket, and the bucket's offset is a running sum over the small table of bucket
counts, so no window holds more than about ``BUCKET_ROWS`` rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabready.functions.arithmetic import round_metric
from tabready.functions.distributions import student_t_quantile, student_t_tail
from tabready.session import ensure_checkpoint_dir

Scorer = Callable[[DataFrame], DataFrame]
BUCKET_ROWS = 1 << 16


def hash_ranks(df: DataFrame, by: Sequence[str], key: str, tie: str, name: str, digits: int) -> DataFrame:
    """Add the 1-based rank by ``(key, tie)`` within ``by``; ``key`` is hex text."""
    cut = df.withColumn("_bucket", F.substring(key, 1, digits))
    counts = cut.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(key, tie))
    return cut.withColumn("_own", own).join(offsets, [*by, "_bucket"]).withColumn(
        name, F.col("_before") + F.col("_own")).drop("_bucket", "_own", "_before")


def repeat_importance(
    sample: DataFrame,
    scorer: Scorer,
    features: Sequence[str],
    target: str,
    identifier: str,
    repeats: int = 3,
    seed: int = 42,
    sample_size: int | None = None,
) -> DataFrame:
    """``feature, repeat, importance``: ``RMSE(permuted) - RMSE(original)`` of
    every permutation.

    All rows of ``sample`` are scored; ``sample_size`` asks for a repeatable
    sample of that many rows instead.  ``scorer`` adds a ``predicted`` column to
    any frame with the feature columns.
    """
    if sample_size is not None:
        from tabready.operators.split import sample_rows

        sample = sample_rows(sample, identifier, sample_size, seed)
    ident = F.col(identifier).cast("string")
    combos = F.array(*[F.struct(F.lit(f).alias("_feature"), F.lit(r).alias("_repeat"))
                       for f in features for r in range(1, repeats + 1)])
    # checkpointed (reliably, to spark.checkpoint.dir) because four branches of the plan read it
    ensure_checkpoint_dir(sample.sparkSession)
    base = sample.select(identifier, target, *features)
    digits = max(1, math.ceil(math.log(max(base.count(), 1) / BUCKET_ROWS + 1, 16)))
    keyed = base.withColumns({"_id": ident, "_all": F.lit(0), "_key": F.md5(F.concat(F.lit(f"{seed}:"), ident))})
    positioned = hash_ranks(keyed, ["_all"], "_key", "_id", "_pos", digits).drop("_all", "_key", "_id").checkpoint(eager=True)
    copies = positioned.select("*", F.explode(combos).alias("_c")).select("*", "_c._feature", "_c._repeat").drop("_c")
    perm_key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_feature"), F.col("_repeat").cast("string"), ident))
    # a donor ships the permuted feature's value only: one column per type, of which one is used
    types = {f: base.schema[f].dataType.simpleString() for f in features}
    donor = {t: f"_donor{i}" for i, t in enumerate(sorted(set(types.values())))}
    given = [F.coalesce(*[F.when(F.col("_feature") == f, F.col(f)) for f in features if types[f] == t]).alias(name) for t, name in donor.items()]
    keyed = copies.select("_feature", "_repeat", perm_key.alias("_key"), ident.alias("_id"), *given)
    donors = hash_ranks(keyed, ["_feature", "_repeat"], "_key", "_id", "_pos", digits).drop("_key", "_id")
    permuted = copies.join(donors, ["_feature", "_repeat", "_pos"]).withColumns(
        {f: F.when(F.col("_feature") == f, F.col(donor[types[f]])).otherwise(F.col(f)) for f in features}
    ).drop("_pos", *donor.values())
    original = positioned.drop("_pos").withColumn("_feature", F.lit(None).cast("string")).withColumn(
        "_repeat", F.lit(0))
    scored = scorer(original.unionByName(permuted))
    err = F.col(target) - F.col("predicted")
    rmse = scored.groupBy("_feature", "_repeat").agg(F.sqrt(F.avg(err * err)).alias("_rmse"))
    # the RMSE table has features x repeats + 1 rows: an unpartitioned window
    # over it reads the baseline without re-running the scoring plan
    base_rmse = F.max(F.when(F.col("_repeat") == 0, F.col("_rmse"))).over(Window.partitionBy(F.lit(0)))
    per = rmse.withColumn("importance", F.col("_rmse") - base_rmse).filter(F.col("_repeat") > 0)
    return per.select(F.col("_feature").alias("feature"), F.col("_repeat").alias("repeat"), "importance")


def permutation_importance(sample: DataFrame, scorer: Scorer, features: Sequence[str], target: str, identifier: str, repeats: int = 3,
                           seed: int = 42, sample_size: int | None = None) -> DataFrame:
    """Mean and (population) standard deviation of ``repeat_importance``."""
    per = repeat_importance(sample, scorer, features, target, identifier, repeats, seed, sample_size)
    return per.groupBy("feature").agg(
        round_metric(F.avg("importance")).alias("importance_mean"),
        round_metric(F.stddev_pop("importance")).alias("importance_std"),
        F.count(F.lit(1)).alias("repeats"),
    )


def importance_statistics(per_repeat: DataFrame, level: float = 0.99, by: Sequence[str] = ("feature",)) -> DataFrame:
    """``importance, stddev, p_value, n`` and the two ends of the interval
    that holds the mean with probability ``level``, from one row per repeat.

    ``p_value`` is the one-sided chance of a mean at least as large if the
    feature had no importance (Student's t with n - 1 degrees of freedom, sample
    standard deviation).  Repeats that agree exactly leave no doubt: 0 or 1 by
    the mean's sign, 0.5 for 0, and an interval of no width.  A single repeat
    says nothing about its spread: null.
    """
    # differences of errors that should be equal differ in the order of their sums
    settled = per_repeat.withColumn("importance", round_metric("importance", 9))
    stats = settled.groupBy(*by).agg(F.avg("importance").alias("importance"), F.stddev_samp("importance").alias("stddev"),
                                        F.count("importance").alias("n"))
    df, error = F.col("n") - 1, F.col("stddev") / F.sqrt("n")
    half = error * student_t_quantile(F.lit((1 - level) / 2), df)
    certain = F.when(F.col("importance") > 0, 0.0).when(F.col("importance") < 0, 1.0).otherwise(0.5)
    p = F.when(F.col("stddev") == 0, certain).otherwise(student_t_tail(F.col("importance") / F.when(error > 0, error), df))
    name = f"p{round(level * 100)}"
    return stats.select(*by, round_metric("importance").alias("importance"), round_metric("stddev").alias("stddev"), round_metric(p).alias("p_value"),
                        "n", round_metric(F.col("importance") - half).alias(f"{name}_low"), round_metric(F.col("importance") + half).alias(f"{name}_high"))


def fold_vector_importance(
    importances, attrs: Sequence[tuple[int, str]], sources: Sequence[str]
) -> list[tuple[str, float]]:
    """Sum a fitted model's per-slot importances back to source columns.

    ``attrs`` are ``(slot index, slot name)`` pairs from the assembled vector's
    ML attribute metadata; a one-hot slot ``lang_en`` folds into ``lang``.
    """
    out = {s: 0.0 for s in sources}
    for idx, name in attrs:
        src = next((s for s in sorted(sources, key=len, reverse=True) if name == s or name.startswith(s + "_")),
                   name)
        out[src] = out.get(src, 0.0) + float(importances[idx])
    return sorted(out.items(), key=lambda kv: (-kv[1], kv[0]))


def model_importance(spark, ranked_models: Sequence[tuple[str, object]], attrs, sources, max_models: int = 5):
    """Importances of the best-ranked model that exposes them among the
    first ``max_models``; raises listing the checked models otherwise.

    ``ranked_models`` are ``(name, fitted model)`` in leaderboard order.
    The result is a small ``(model, variable, relative_importance)`` table.
    """
    checked = []
    for name, model in list(ranked_models)[:max_models]:
        checked.append(name)
        imp = getattr(model, "featureImportances", None)
        if imp is None or imp.size == 0:
            continue
        rows = [(name, v, w) for v, w in fold_vector_importance(imp.toArray(), attrs, sources)]
        return spark.createDataFrame(rows, "model string, variable string, relative_importance double")
    raise RuntimeError(f"none of the models {checked} has importances")
