"""Joins with tables that are expected to be small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a side that may be broadcast.
BROADCAST_ROWS = 100_000


def join_small(df: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join with ``small``, a table that is cheap to count (checkpointed or
    written).  It is broadcast if its counted rows allow that, whatever its
    static size estimate; otherwise this is an ordinary join."""
    return df.join(F.broadcast(small) if small.count() <= BROADCAST_ROWS else small, list(on), how)
