"""P10, A2, F4-F6, A6 and P11 with the reference's fixture values."""

import pytest
from pyspark.sql import functions as F

from tabready.operators import target as T
from tabready.operators.features import add_engineered_features, body_features

COMPONENTS = ["part_a", "part_b", "part_c", "part_d"]


def test_target_components(spark):
    df = spark.createDataFrame([(100.0, 50.0, 40.0, 80.0), (1.0, 50.0, 40.0, 80.0), (100.0, None, 40.0, 80.0)],
                               ", ".join(f"{c} double" for c in COMPONENTS))
    out = [r.total for r in T.build_target(df, "total", COMPONENTS, [1]).collect()]
    assert out == [270.0, None, None]
    counts = {r.component: r.sentinel_count for r in T.sentinel_counts(df, COMPONENTS, [1]).collect()}
    assert counts == {"part_a": 1, "part_b": 0, "part_c": 0, "part_d": 0}


def test_non_positive_masked_in_preparation_only(spark):
    df = spark.createDataFrame([("a", 0.0, 50.0, 40.0, 80.0)], "id string, " + ", ".join(f"{c} double" for c in COMPONENTS))
    assert T.build_target(df, "t", COMPONENTS, [1]).first().t is None
    ready = T.target_readiness(df, COMPONENTS, [1], "id").first()
    assert ready.eligible_rows == 1 and ready.target_min == 170.0


def test_missing_component_column_raises(spark):
    df = spark.createDataFrame([(1.0,)], "part_a double")
    with pytest.raises(ValueError, match="lacks target components"):
        T.build_target(df, "t", COMPONENTS, [1])


def raw_sample(spark):
    rows = [
        (1.0, 30, "male", 100.0, 50.0, 40.0, 80.0),
        (None, 25, "female", 100.0, 50.0, 40.0, 80.0),
        (3.0, 40, "male", 1.0, 50.0, 40.0, 80.0),
        (4.0, 35, "female", 100.0, None, 40.0, 80.0),
        (5.0, 28, "male", 120.0, 60.0, 50.0, 90.0),
    ]
    return spark.createDataFrame(rows, "member_id double, age bigint, gender string, part_a double, "
                                       "part_b double, part_c double, part_d double")


def test_target_readiness(spark):
    r = T.target_readiness(raw_sample(spark), COMPONENTS, [1], "member_id").first()
    assert (r.initial_rows, r.missing_identifier_rows, r.missing_or_invalid_target_rows, r.eligible_rows) == (5, 1, 2, 2)
    assert r.total_sentinel_replacements == 1
    assert (r.target_min, r.target_max, r.target_mean) == (270.0, 320.0, 295.0)


def test_prep_funnel_is_monotone(spark):
    df = T.build_target(raw_sample(spark), "total", COMPONENTS, [1]).withColumn(
        "member_id", F.when(F.col("member_id") == 5.0, F.lit(1.0)).otherwise(F.col("member_id")))
    f = T.prep_funnel(df, "total", "member_id", ["age", "gender"]).first()
    assert f.initial_rows == 5
    assert f.rows_after_target_filter == 3
    assert f.missing_identifier_rows == 1
    assert f.rows_after_identifier_filter == 2
    assert f.duplicate_identifier_rows == 2
    assert f.duplicates_removed == 1
    assert f.final_rows == 1
    steps = [f.initial_rows, f.rows_after_target_filter, f.rows_after_identifier_filter,
             f.rows_after_required_filter, f.final_rows]
    assert steps == sorted(steps, reverse=True)


def test_bounds_inclusive(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([8.0, 1000.0, 2367.0, 2500.0, 2501.0, None])],
                               "member_id bigint, total double")
    audit = T.audit_target_outliers(df, "total", 8, 2500)
    reasons = sorted(r.target_quality_reason for r in audit.collect())
    assert reasons == ["above_maximum", "missing_target"]
    kept = T.filter_valid_target(df, "total", 8, 2500)
    vals = sorted(r.total for r in kept.collect())
    assert vals == [8.0, 1000.0, 2367.0, 2500.0]
    assert audit.count() + kept.count() == df.count()


def test_target_statistics(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 101)], "t double")
    s = T.target_statistics(df, "t").first()
    assert (s.target_count, s.target_min, s.target_max, s.target_mean, s.target_median) == (100, 1.0, 100.0, 50.5, 50.5)
    assert s.target_p99 == pytest.approx(99.01)


def test_body_features(spark):
    df = spark.createDataFrame([(30.0, 70.0, 200.0), (30.0, 0.0, 200.0)], "age double, height double, weight double")
    rows = add_engineered_features(df, body_features()).collect()
    assert rows[0].bmi == pytest.approx(28.6939, abs=1e-4)
    assert rows[0].age_squared == 900.0
    assert rows[0].weight_height_ratio == pytest.approx(200 / 70)
    assert rows[1].bmi is None and rows[1].weight_height_ratio is None
