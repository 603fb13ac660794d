"""Approximate distinct counts from stored sketches.

Each data file's columns are sketched once (Spark's HyperLogLog sketches, which
merge); a profile unites the stored sketches, so neither a new profile nor one
over a subset of files reads data again, and files that arrive later are sketched
alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The logarithm of a sketch's slots: 2^12 give a relative error of about 1.6 %
#: (one standard deviation).
LOG_SLOTS = 12
#: Standard deviations within which an estimate is said to lie.
DEVIATIONS = 4.0


def relative_bound(log_slots: int = LOG_SLOTS, deviations: float = DEVIATIONS) -> float:
    """How far an estimate may be off, relative to the exact count."""
    return deviations * 1.04 / math.sqrt(1 << log_slots)


def file_sketches(df: DataFrame, columns: Sequence[str], log_slots: int = LOG_SLOTS) -> DataFrame:
    """``file, column, rows, missing, sketch``: one row per data file and column
    of a frame read from files; NaN counts as missing."""
    def text(c: str):
        value = F.col(f"`{c}`").cast("string")
        return F.when(value != "NaN", value) if dict(df.dtypes)[c] in ("double", "float") else value

    aggs = [x for i, c in enumerate(columns) for x in (F.hll_sketch_agg(text(c), F.lit(log_slots)).alias(f"_s{i}"),
                                                       F.count_if(text(c).isNull()).alias(f"_m{i}"))]
    wide = df.select(F.input_file_name().alias("file"), *columns).groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *aggs)
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("missing"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(columns)]
    return wide.select("file", "rows", F.explode(F.array(*cells)).alias("_c")).select("file", "_c.column", "rows", "_c.missing", "_c.sketch")


def approximate_profile(sketches: DataFrame) -> DataFrame:
    """``column, rows, missing, approx_unique`` over all files of the sketches."""
    return sketches.groupBy("column").agg(F.sum("rows").alias("rows"), F.sum("missing").alias("missing"),
                                          F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_unique"))


def check_estimates(profile: DataFrame, exact: DataFrame, log_slots: int = LOG_SLOTS) -> DataFrame:
    """Estimates beside exact counts (``column, unique_count``), with the bound
    and whether it holds."""
    bound = F.lit(relative_bound(log_slots))
    off = F.abs(F.col("approx_unique") - F.col("unique_count"))
    return profile.join(exact.select("column", "unique_count"), "column").select(
        "column", "rows", "missing", "approx_unique", "unique_count", (bound * F.col("unique_count")).alias("bound"),
        (off <= F.greatest(bound * F.col("unique_count"), F.lit(1.0))).alias("within_bound"))
