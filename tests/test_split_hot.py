"""An identifier with more rows than a window holds."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tabready.operators.split import _boundary_keys

IDS = ["hot"] * 60 + [f"id{i}" for i in range(20)]


def bounds(spark, cuts):
    df = spark.createDataFrame([(i,) for i in IDS], "id string").repartition(4)
    return _boundary_keys(df, "id", 42, lambda total: [F.lit(c) for c in cuts], 2, max_window_rows=8)


def test_hot_identifier_is_told_from_the_counts(spark):
    with pytest.raises(ValueError, match="identifier 'hot' repeats at a cut"):
        bounds(spark, [30, 40])


def test_a_cut_behind_a_hot_identifier_is_exact(spark):
    ranked = sorted((hashlib.md5(f"42:{i}".encode()).hexdigest(), i) for i in IDS)
    end = max(k for k, (_, i) in enumerate(ranked, 1) if i == "hot")
    assert bounds(spark, [end]) == [ranked[end - 1]]
    if end < len(ranked):
        assert bounds(spark, [end, len(ranked)]) == [ranked[end - 1], ranked[-1]]
