"""SURVEY 3.1 end to end on a hand-written raw table and contract."""

from pyspark.sql import functions as F

from tabready.contract import Contract
from tabready.operators.split import split_sizes
from tabready.plans.prepare import prepare_and_split, prepare_table, quality_gate_and_resplit


def contract():
    return Contract(
        identifier="pid", target="total", components=("a", "b"), sentinels=(1.0,),
        numeric_features=("age",), categorical_features=("team",), required_features=("age",),
        engineered={"age_sq": F.pow(F.col("age"), 2)}, valid_ranges={"age": (10.0, 90.0)},
        target_bounds=(5.0, 500.0),
    )


def raw(spark):
    rows = [
        ("p1", "10", "20", "30", " Red "),     # kept: total 30
        ("p1", "10", "20", None, "red"),       # duplicate id, less complete -> dropped
        ("p2", "1", "20", "40", "blue"),       # sentinel component -> no target -> dropped
        ("p3", "200", "400", "50", "blue"),    # total 600, kept here, removed by the quality gate
        ("p4", "7", "8", "5", "green"),        # age out of range -> NULL -> required missing -> dropped
        (None, "3", "4", "33", "red"),         # no identifier -> dropped
    ] + [(f"q{i}", str(10 + i), "5", str(20 + i % 50), "x") for i in range(40)]
    return spark.createDataFrame(rows, "pid string, a string, b string, age string, team string")


def test_prepare_table(spark):
    out = {r.pid: r for r in prepare_table(raw(spark), contract()).collect()}
    assert set(out) == {"p1", "p3", *[f"q{i}" for i in range(40)]}
    assert out["p1"].total == 30.0 and out["p1"].age == 30.0 and out["p1"].age_sq == 900.0
    assert out["p1"].team == "red"
    assert list(prepare_table(raw(spark), contract()).columns) == ["pid", "age", "team", "age_sq", "total"]


def test_split_and_quality_gate(spark):
    split = prepare_and_split(raw(spark), contract())
    counts = {r.data_split: r["count"] for r in split.groupBy("data_split").count().collect()}
    assert (counts["train"], counts["validation"], counts["test"]) == split_sizes(42, (0.64, 0.16, 0.20))
    gated = quality_gate_and_resplit(split, contract())
    assert gated.filter(F.col("pid") == "p3").count() == 0 and gated.count() == 41


def test_export_splits(spark):
    import tempfile

    import pytest

    from tabready.plans.prepare import export_splits

    base = tempfile.mkdtemp(prefix="tabready-export-")
    split = prepare_and_split(raw(spark), contract())
    back = spark.read.parquet(export_splits(split, contract(), base))
    assert back.count() == 42
    assert {r.data_split for r in back.select("data_split").distinct().collect()} == {"train", "validate", "test"}
    with pytest.raises(ValueError, match="duplicate_identifiers"):
        export_splits(split.unionByName(split.limit(1)), contract(), base)
