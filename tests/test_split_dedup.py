"""M1-M3, J5, U1, U2, U5, W1, A3, A4."""

import pytest
from pyspark.sql import functions as F

from tabready.operators import dedup, split
from tabready.operators.gates import validate_split_export


def split_100(spark):
    return spark.createDataFrame([(i, 20 + i % 30, 1000 + i) for i in range(100)],
                                 "member_id bigint, age bigint, total bigint")


def _labels(df):
    return {r.member_id: r.data_split for r in df.collect()}


def test_exact_sizes_repeatable_disjoint(spark):
    df = split_100(spark)
    a = split.deterministic_split(df, "member_id")
    sizes = {r.data_split: r["count"] for r in a.groupBy("data_split").count().collect()}
    assert sizes == {"train": 64, "validation": 16, "test": 20}
    # same labels on a second run and after repartitioning the input
    assert _labels(a) == _labels(split.deterministic_split(df.repartition(7), "member_id"))
    assert split.split_isolation_summary(a, "member_id").first().identifiers_in_multiple_splits == 0


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_bucket_width_does_not_change_labels(spark, digits):
    df = split_100(spark)
    assert _labels(split.deterministic_split(df, "member_id", hex_digits=digits)) == _labels(
        split.deterministic_split(df, "member_id"))


def test_split_sizes_rule():
    assert split.split_sizes(53534, (0.64, 0.16, 0.20)) == (34261, 8566, 10707)
    assert split.split_sizes(53505, (0.64, 0.16, 0.20)) == (34243, 8561, 10701)


def test_fractions_must_sum_to_one(spark):
    with pytest.raises(ValueError, match="with sum 1"):
        split.deterministic_split(split_100(spark), "member_id", (0.5, 0.2, 0.2))


def test_sample_rows(spark):
    df = split_100(spark)
    s = split.sample_rows(df, "member_id", 30)
    assert s.count() == 30 and s.select("member_id").distinct().count() == 30
    assert _labels(s.withColumn("data_split", F.lit("x"))) == _labels(
        split.sample_rows(df.repartition(5), "member_id", 30).withColumn("data_split", F.lit("x")))
    assert split.sample_rows(df, "member_id", 500).count() == 100


def frames(spark):
    schema = "member_id bigint, age bigint, weight bigint, total bigint"
    mk = lambda ids: spark.createDataFrame([(i, 30, 180, 300 + i) for i in ids], schema)
    return {"train": mk(range(6)), "validate": mk(range(6, 8)), "test": mk(range(8, 10))}


def test_combine_splits(spark):
    out = split.combine_splits(frames(spark))
    assert out.count() == 10
    assert sorted(r[0] for r in out.select("data_split").distinct().collect()) == ["test", "train", "validate"]
    labels = {r.split_label: (r.observed, r.expected) for r in split.distinct_split_labels(out).collect()}
    assert labels == {"train": (True, True), "validate": (True, True), "test": (True, True)}


def test_combine_rejects_order_and_columns(spark):
    f = frames(spark)
    with pytest.raises(ValueError, match="in this order"):
        split.combine_splits({"validate": f["validate"], "train": f["train"], "test": f["test"]})
    f["test"] = f["test"].drop("weight")
    with pytest.raises(ValueError, match="columns of 'test' differ"):
        split.combine_splits(f)


def test_overlap_detected(spark):
    combined = split.combine_splits(frames(spark)).withColumn(
        "member_id", F.when(F.col("member_id") == 9, F.lit(1)).otherwise(F.col("member_id")))
    assert split.split_isolation_summary(combined, "member_id").first().identifiers_in_multiple_splits == 1
    checks = {r.check_name: r.status for r in validate_split_export(combined, "member_id", "total").collect()}
    assert checks["identifiers_in_multiple_splits"] == "FAIL"
    assert checks["duplicate_identifiers"] == "FAIL"
    assert checks["label_set"] == "PASS"
    pairs = {(r.left_split, r.right_split): r.shared_identifiers
             for r in split.id_overlap_between_splits(combined, "member_id", labels=("train", "validate", "test")).collect()}
    assert pairs[("train", "test")] == 1 and pairs[("train", "validate")] == 0


def test_dedup_most_complete(spark):
    rows = [("a", 1.0, None, "x"), ("a", 1.0, 2.0, "y"), ("b", None, None, "z"), ("b", 3.0, None, "w"),
            ("c", 5.0, 5.0, "q"), (None, 1.0, 1.0, "n1"), (None, 1.0, 1.0, "n2")]
    df = spark.createDataFrame(rows, "id string, f1 double, f2 double, tag string")
    out = {r.id: r.tag for r in dedup.dedup_most_complete(df, "id", ["f1", "f2"]).collect() if r.id}
    assert out == {"a": "y", "b": "w", "c": "q"}
    assert dedup.dedup_most_complete(df, "id", ["f1", "f2"]).filter(F.col("id").isNull()).count() == 2


def test_dedup_ties_are_deterministic(spark):
    rows = [("a", 1.0, "x"), ("a", 1.0, "b"), ("a", 1.0, "m")]
    df = spark.createDataFrame(rows, "id string, f1 double, tag string")
    picks = {dedup.dedup_most_complete(df.repartition(n), "id", ["f1"]).first().tag for n in (1, 2, 3)}
    assert picks == {"b"}


def test_duplicate_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 3), ("c", 4), ("c", 4)], "id string, v int")
    ids = dedup.count_duplicate_identifiers(df, "id").first()
    assert (ids.duplicated_identifiers, ids.duplicate_identifier_rows) == (2, 5)
    assert dedup.count_duplicate_rows(df).first().duplicate_rows == 2


def test_large_boundary_buckets_are_refined(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"))
    plain = {r.k: r.data_split for r in split.deterministic_split(df, "k", hex_digits=1).collect()}
    refined = {r.k: r.data_split
               for r in split.deterministic_split(df, "k", hex_digits=1, max_window_rows=3).collect()}
    assert refined == plain
    sizes = split.split_sizes(500, (0.64, 0.16, 0.20))
    assert tuple(sum(1 for v in refined.values() if v == lab) for lab in ("train", "validation", "test")) == sizes
