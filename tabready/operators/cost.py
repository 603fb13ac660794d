"""What a pass costs, measured by the pass itself.

``Observation`` counts the rows and cells that went through, in the same job, and
the wall clock stands around it.  Rows and cells are the same in every run and can
be ranked and compared; seconds are what this run took.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

COSTS = "model string, step string, rows long, cells long, seconds double"


@dataclass(frozen=True)
class Cost:
    rows: int
    cells: int
    seconds: float


def observed(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, Observation]:
    """The frame with a count of its rows and of the cells of ``columns`` that hold a value."""
    seen = Observation()
    cells = sum((F.count(F.col(f"`{c}`")) for c in columns), F.lit(0))
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), cells.cast("long").alias("cells")), seen


def measured(df: DataFrame, columns: Sequence[str], consume: Callable[[DataFrame], object] | None = None) -> tuple[object, Cost]:
    """Run one pass over ``df``, by default a write to nowhere, and say what it read and took."""
    watched, seen = observed(df, columns)
    began = time.perf_counter()
    out = consume(watched) if consume else watched.write.format("noop").mode("overwrite").save()
    took = time.perf_counter() - began
    got = seen.get
    return out, Cost(int(got["rows"]), int(got["cells"]), took)


def measured_costs(spark: SparkSession, train: DataFrame, score: DataFrame, target: str,
                   fits: Mapping[str, tuple[Sequence[str], Callable[[DataFrame], Callable[[DataFrame], DataFrame]]]]) -> DataFrame:
    """Per model two rows, ``fit`` and ``predict``.  ``fits`` maps a model to its
    features and its fit, a function from a train frame to a scorer that has read
    the frame when it returns."""
    rows = []
    for name, (features, fit) in fits.items():
        scorer, cost = measured(train.select(*features, target), [*features, target], fit)
        rows.append((name, "fit", cost.rows, cost.cells, cost.seconds))
        # the noop write makes the predictions; what the scorer is given is what is counted
        watched, seen = observed(score.select(*features), features)
        began = time.perf_counter()
        scorer(watched).select("predicted").write.format("noop").mode("overwrite").save()
        took, got = time.perf_counter() - began, seen.get
        rows.append((name, "predict", int(got["rows"]), int(got["cells"]), took))
    return spark.createDataFrame(rows, COSTS)


def cost_columns(costs: DataFrame) -> DataFrame:
    """One row per model for a leaderboard: ``fit_seconds, fit_cells``, and per
    predicted row ``predict_seconds_per_row, predict_cells_per_row``."""
    of = lambda step, c: F.max(F.when(F.col("step") == step, F.col(c)))
    wide = costs.groupBy("model").agg(of("fit", "rows").alias("fit_rows"), of("fit", "cells").alias("fit_cells"),
                                      of("fit", "seconds").alias("fit_seconds"), of("predict", "rows").alias("_rows"),
                                      of("predict", "cells").alias("_cells"), of("predict", "seconds").alias("_seconds"))
    per = lambda c: F.col(c) / F.when(F.col("_rows") > 0, F.col("_rows"))
    return wide.select("model", "fit_rows", "fit_cells", "fit_seconds", F.col("_rows").alias("predict_rows"),
                       per("_cells").alias("predict_cells_per_row"), per("_seconds").alias("predict_seconds_per_row"))
