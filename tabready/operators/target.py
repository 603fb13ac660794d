"""Target construction, readiness, funnel, outlier audit and statistics
(P10, P9 counts, F1-F6, A2, A6, A7).

All summaries are single-pass conditional aggregates: one scan, partial
aggregation on every map task, no per-filter jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabready.functions.arithmetic import long_form, round_metric
from tabready.functions.cleaning import is_sentinel, null_sentinels, present, safe_float
from tabready.operators.quantiles import aggregate_with_quantiles


def cleaned_components(
    components: Sequence[str], sentinels: Sequence[float], mask_non_positive: bool = True
) -> list[Column]:
    """Each component as a number with sentinels (and optionally ``<= 0``) masked."""
    out = []
    for c in components:
        v = null_sentinels(safe_float(c), sentinels)
        if mask_non_positive:
            v = F.when(v > 0, v)
        out.append(v)
    return out


def target_expr(components: Sequence[str], sentinels: Sequence[float], mask_non_positive: bool = True) -> Column:
    """P10: sum of all components; NULL if any is missing, a sentinel or ``<= 0``.

    Null-propagating ``+`` in fixed component order (min_count = all).
    """
    parts = cleaned_components(components, sentinels, mask_non_positive)
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def build_target(
    df: DataFrame, target: str, components: Sequence[str], sentinels: Sequence[float], mask_non_positive: bool = True
) -> DataFrame:
    """P10: add the target column.  Raises if a component column is missing."""
    missing = sorted(set(components) - set(df.columns))
    if missing:
        raise ValueError(f"the table lacks target components: {missing}")
    return df.withColumn(target, target_expr(components, sentinels, mask_non_positive))


def sentinel_counts(df: DataFrame, components: Sequence[str], sentinels: Sequence[float]) -> DataFrame:
    """P9 counts: ``(component, sentinel_count)`` per component, one scan."""
    agg = df.agg(*[F.count_if(is_sentinel(safe_float(c), sentinels)).alias(f"n{i}") for i, c in enumerate(components)])
    return long_form(agg, {c: f"n{i}" for i, c in enumerate(components)}, "component", "sentinel_count")


def target_readiness(
    df: DataFrame, components: Sequence[str], sentinels: Sequence[float], identifier: str | None
) -> DataFrame:
    """A2: rows, missing ids, invalid targets, eligible rows, sentinel total and
    target statistics over eligible rows.  Zeros and negatives are *kept* here
    (H3), unlike P10's preparation definition.  One row, one scan."""
    parts = cleaned_components(components, sentinels, mask_non_positive=False)
    complete = F.lit(True)
    for p in parts:
        complete = complete & p.isNotNull()
    id_ok = F.col(identifier).isNotNull() if identifier and identifier in df.columns else F.lit(True)
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    eligible = id_ok & complete
    t = F.when(eligible, total)
    sentinel_total = None
    for c in components:
        n = F.count_if(is_sentinel(safe_float(c), sentinels))
        sentinel_total = n if sentinel_total is None else sentinel_total + n
    aggs = [
        F.count(F.lit(1)).alias("initial_rows"),
        F.count_if(~id_ok).alias("missing_identifier_rows"),
        F.count_if(id_ok & ~complete).alias("missing_or_invalid_target_rows"),
        F.count_if(eligible).alias("eligible_rows"),
        sentinel_total.alias("total_sentinel_replacements"),
        F.count(t).alias("target_count"),
        F.min(t).alias("target_min"),
        F.max(t).alias("target_max"),
        round_metric(F.avg(t)).alias("target_mean"),
        round_metric(F.stddev_samp(t)).alias("target_std"),
    ]
    out = aggregate_with_quantiles(df, t, aggs, [0.5], ["target_median"])
    return out.withColumn("target_median", round_metric("target_median")).select(
        "initial_rows", "missing_identifier_rows", "missing_or_invalid_target_rows", "eligible_rows",
        "total_sentinel_replacements", "target_count", "target_min", "target_max", "target_mean",
        "target_median", "target_std")


# ---- F1-F3: row filters -------------------------------------------------------

def filter_complete_target(df: DataFrame, target: str) -> DataFrame:
    """F1."""
    return df.filter(F.col(target).isNotNull())


def filter_identified(df: DataFrame, identifier: str) -> DataFrame:
    """F2."""
    return df.filter(F.col(identifier).isNotNull())


def drop_missing_required(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """F3."""
    return df.dropna(subset=list(required)) if required else df


def prep_funnel(df: DataFrame, target: str, identifier: str, required: Sequence[str]) -> DataFrame:
    """rows after each preparation step, as one row.

    ``df`` is the cleaned frame *before* the row filters.  One shuffle on the
    identifier with map-side partial counts, so a hot identifier costs one
    buffer row per map task, not a third of the data in one task.
    """
    has_target = F.col(target).isNotNull()
    has_id = has_target & F.col(identifier).isNotNull()
    complete = F.lit(True)
    for c in required:
        complete = complete & F.col(c).isNotNull()
    keeps = has_id & complete
    per_id = df.groupBy(identifier).agg(
        F.count(F.lit(1)).alias("n_raw"),
        F.count_if(has_target).alias("n_target"),
        F.count_if(has_id).alias("n_id"),
        F.count_if(keeps).alias("n_kept"),
    )
    return per_id.agg(
        F.sum("n_raw").alias("initial_rows"),
        F.sum("n_target").alias("rows_after_target_filter"),
        (F.sum("n_target") - F.sum("n_id")).alias("missing_identifier_rows"),
        F.sum("n_id").alias("rows_after_identifier_filter"),
        (F.sum("n_id") - F.sum("n_kept")).alias("rows_removed_for_required_features"),
        F.sum("n_kept").alias("rows_after_required_filter"),
        F.coalesce(F.sum(F.when(F.col("n_kept") > 1, F.col("n_kept"))), F.lit(0)).alias("duplicate_identifier_rows"),
        (F.sum("n_kept") - F.count_if(F.col("n_kept") > 0)).alias("duplicates_removed"),
        F.count_if(F.col("n_kept") > 0).alias("final_rows"),
    )


# ---- F5 / F6: target quality gate --------------------------------------------

def outlier_reason(target: str | Column, minimum: float, maximum: float) -> Column:
    t = safe_float(target)
    return (
        F.when(t.isNull(), "missing_target")
        .when(t < minimum, "below_minimum")
        .when(t > maximum, "above_maximum")
    )


def audit_target_outliers(df: DataFrame, target: str, minimum: float, maximum: float) -> DataFrame:
    """rows with a missing / below-minimum / above-maximum target, with reason."""
    return df.withColumn("target_quality_reason", outlier_reason(target, minimum, maximum)).filter(
        F.col("target_quality_reason").isNotNull()
    )


def filter_valid_target(df: DataFrame, target: str, minimum: float, maximum: float) -> DataFrame:
    """keep rows with ``minimum <= target <= maximum`` (inclusive); target as double."""
    t = safe_float(target)
    return df.filter(t.between(minimum, maximum)).withColumn(target, t)


# ---- A6 / A7 -------------------------------------------------------------------

def target_statistics(df: DataFrame, target: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, min, max, mean, median, sample std and p99, optionally grouped.

    Median and p99 are exact, computed by bounded histogram narrowing
    (``quantiles.exact_quantiles``) rather than a per-group value map."""
    t = present(df, target)
    aggs = [
        F.count(t).alias("target_count"),
        F.min(t).alias("target_min"),
        F.max(t).alias("target_max"),
        round_metric(F.avg(t)).alias("target_mean"),
        round_metric(F.stddev_samp(t)).alias("target_std"),
    ]
    names = ["target_median", "target_p99"]
    out = aggregate_with_quantiles(df, t, aggs, [0.5, 0.99], names, by)
    return out.withColumns({n: round_metric(n) for n in names}).select(
        *by, "target_count", "target_min", "target_max", "target_mean", "target_median", "target_std", "target_p99")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts per value combination (outlier reason, role, action, split)."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))
