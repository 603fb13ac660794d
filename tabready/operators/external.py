"""Scoring with a model from outside Spark.

The model is anything picklable with a ``predict`` that takes a float matrix and
gives one number per row.  It is broadcast once, after a check of its size, and
called on Arrow batches of at most ``batch_rows`` rows, so that a task's memory
doesn't depend on its partition.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Largest pickled model that is broadcast.
MAX_MODEL_BYTES = 256 << 20


def score_external(df: DataFrame, model: object, features: Sequence[str], keep: Sequence[str] = (), batch_rows: int = 8_192,
                   max_model_bytes: int = MAX_MODEL_BYTES) -> DataFrame:
    """``keep`` columns and ``predicted``.

    Features are cast to doubles, a null becomes NaN; a row whose prediction is
    not a finite number gets null.  A model that gives another number of
    predictions than it was given rows fails the query, as does one that is too
    large to broadcast.  A column kept under the name ``predicted`` is an error.
    """
    if "predicted" in keep:
        raise ValueError("a kept column would clash with the predictions")
    packed = cloudpickle.dumps(model)
    if len(packed) > max_model_bytes:
        raise ValueError(f"the model has {len(packed)} bytes, more than the {max_model_bytes} that may be broadcast")
    shared = df.sparkSession.sparkContext.broadcast(packed)
    inputs = [F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(float("nan"))).alias(f"_x{i}") for i, f in enumerate(features)]
    rows = df.select(*keep, *inputs)
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("predicted", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = pickle.loads(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, batch_rows):
                part = batch.slice(at, batch_rows)
                matrix = np.empty((part.num_rows, len(features)))
                for i in range(len(features)):
                    matrix[:, i] = part.column(f"_x{i}").to_numpy(zero_copy_only=False)
                got = np.asarray(scorer.predict(matrix), float)
                if got.shape != (part.num_rows,):
                    raise ValueError(f"the model gave predictions of shape {got.shape} for {part.num_rows} rows")
                predicted = pa.array(got, mask=~np.isfinite(got))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], predicted], [*keep, "predicted"])

    return rows.mapInArrow(run, schema)


class LinearScorer:
    """A plain linear model, as an external library would hand it over."""

    def __init__(self, intercept: float, weights: Sequence[float]):
        self.intercept, self.weights = intercept, np.array(weights, float)

    def predict(self, rows: np.ndarray) -> np.ndarray:
        return self.intercept + rows @ self.weights
