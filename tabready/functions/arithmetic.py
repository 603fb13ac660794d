"""Scalar arithmetic over metric columns (P14-P16) and rounding helpers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def residual(actual: str | Column, predicted: str | Column) -> Column:
    """``actual - predicted``."""
    return _col(actual) - _col(predicted)


def percent_change(new: str | Column, reference: str | Column, strict: bool = True) -> Column:
    """``(new - ref) / |ref| * 100``.

    ``strict`` raises on a zero reference (the query fails, as the reference
    workflow does); otherwise a zero reference yields NULL (H7).
    """
    new, reference = _col(new), _col(reference)
    value = (new - reference) / F.abs(reference) * 100.0
    if strict:
        return F.when(reference == 0, F.raise_error(F.lit("percent change from zero"))).otherwise(value)
    return F.when(reference != 0, value)


def negated_score_to_error(c: str | Column) -> Column:
    """A higher-is-better score (``-RMSE``) to a positive error; text -> NULL."""
    return -F.nanvl(_col(c).try_cast("double"), F.lit(None).cast("double"))


def round_metric(c: str | Column, digits: int = 6) -> Column:
    """Reported precision for floating aggregates (sums and means of floats are
    order-dependent in the last bits, so reports carry a fixed precision)."""
    return F.round(_col(c), digits)


def long_form(wide: DataFrame, columns: Mapping[str, str], name: str, value: str) -> DataFrame:
    """One ``(name, value)`` row per entry of ``columns`` (label -> column of
    ``wide``); labels are literals, so any text is fine."""
    pairs = [F.struct(F.lit(label).alias(name), F.col(c).alias(value)) for label, c in columns.items()]
    return wide.select(F.explode(F.array(*pairs)).alias("_pair")).select("_pair.*")
