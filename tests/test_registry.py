"""The run registry in long form and what is read back from it."""

import json

import pytest
from pyspark.sql import functions as F

from tabready.sources import registry as R

RUNS = "run_id string, model string, depth int, rmse double, names array<string>, libs map<string,string>, limits map<string,double>"


def entries(spark, rows, recorded, **kinds):
    kinds = kinds or {"param": ["model", "depth", "names"], "metric": ["rmse"], "version": ["libs"], "config": ["limits"]}
    return R.run_entries(spark.createDataFrame(rows, RUNS), "run_id", recorded, **kinds)


ONE = ("r1", 'a "b", c', 3, 0.1 + 0.2, ["x", "y,z"], {"spark": "4.1"}, {"seconds": 1e-300})
TWO = ("r2", None, None, float("nan"), None, None, {})
COLUMNS = {"model": ("param", "model", "string"), "depth": ("param", "depth", "int"), "names": ("param", "names", "array<string>"),
           "rmse": ("metric", "rmse", "double"), "spark": ("version", "spark", "string"), "seconds": ("config", "seconds", "double")}


def test_values_come_back_as_they_were(spark, tmp_path):
    R.append_entries(entries(spark, [ONE, TWO], 1), str(tmp_path / "r"))
    got = {r.run_id: r for r in R.pivot_runs(R.read_entries(spark, str(tmp_path / "r")), COLUMNS).collect()}
    assert tuple(got["r1"])[1:] == (ONE[1], 3, ["x", "y,z"], 0.1 + 0.2, "4.1", 1e-300)
    assert got["r2"].model is None and got["r2"].depth is None and got["r2"].spark is None and got["r2"].rmse != got["r2"].rmse


def test_last_write_wins_for_each_key(spark, tmp_path):
    path = str(tmp_path / "r")
    R.append_entries(entries(spark, [ONE], 5), path)
    late = ("r1", None, 9, 7.0, ["late"], {"spark": "5", "other": "1"}, None)
    R.append_entries(entries(spark, [late], 3, param=["depth"], version=["libs"]), path)  # recorded before: loses
    R.append_entries(entries(spark, [late], 6, param=["model"], metric=["rmse"]), path)  # model is taken away
    got = R.pivot_runs(R.read_entries(spark, path), {**COLUMNS, "other": ("version", "other", "string")}).first()
    assert (got.model, got.depth, got.rmse, got.spark, got.other) == (None, 3, 7.0, "4.1", "1")
    assert [r["value"] for r in R.metric_history(R.read_entries(spark, path), "rmse").orderBy("recorded").collect()] == [0.1 + 0.2, 7.0]
    compact = R.compact_entries(spark, path, str(tmp_path))
    assert R.pivot_runs(R.read_entries(spark, compact), COLUMNS).first() == R.pivot_runs(R.read_entries(spark, path), COLUMNS).first()
    assert R.read_entries(spark, compact).where("key = 'model'").count() == 0


def test_equal_times_have_one_outcome(spark):
    rows = [("r", "metric", "m", json.dumps({"v": v}), "double", 1) for v in (1.0, 2.0)] + [("r", "metric", "m", None, "double", 1)]
    for order in (rows, rows[::-1]):
        assert R.pivot_runs(spark.createDataFrame(order, R.ENTRIES), {"m": ("metric", "m", "double")}).first().m == 2.0


def test_runs_without_a_wanted_key_stay(spark):
    e = entries(spark, [ONE, ("r2", "m", 1, 1.0, [], {}, {})], 1)
    assert {r.run_id: r.spark for r in R.pivot_runs(e, {"spark": COLUMNS["spark"]}).collect()} == {"r1": "4.1", "r2": None}


def test_found_columns(spark, monkeypatch):
    e = entries(spark, [ONE], 1).unionByName(entries(spark, [ONE], 2, tag=["depth"]))
    found = R.found_columns(e)
    assert list(found) == ["param_depth", "param_model", "param_names", "metric_rmse", "tag_depth", "config_seconds", "version_spark"]
    assert found["param_names"] == ("param", "names", "array<string>")
    assert R.pivot_runs(e, found).first().tag_depth == 3
    monkeypatch.setattr(R, "MAX_FOUND_KEYS", 3)
    with pytest.raises(ValueError, match="over 3 keys"):
        R.found_columns(e)


def test_kinds_are_folders(spark, tmp_path):
    path = str(tmp_path / "r")
    R.append_entries(entries(spark, [ONE], 1), path)
    read = R.read_entries(spark, path, ["metric"])
    assert [r.key for r in read.collect()] == ["rmse"]
    assert "PartitionFilters: [isnotnull(kind" in read._jdf.queryExecution().toString() or "PartitionFilters: [kind" in read._jdf.queryExecution().toString()


def test_maps_and_trials(spark):
    e = entries(spark, [ONE, TWO], 4)
    maps = {r.run_id: r for r in R.run_maps(e).collect()}
    assert maps["r1"].params == {"depth": "3", "model": ONE[1], "names": '["x","y,z"]'} and maps["r1"].metrics == {"rmse": 0.1 + 0.2}
    assert maps["r1"].versions == {"spark": "4.1"} and maps["r1"].last_recorded == 4
    trials = R.trial_rows(e, "rmse", "seconds")
    one = trials.where("run_id = 'r1'").first()
    assert json.loads(one.params_json) == {"depth": "3", "model": ONE[1], "names": '["x","y,z"]'} and one.score == 0.1 + 0.2 and one.duration is None
    back = R.typed_trials(trials, "depth int, model string, absent double", "rmse double").where("run_id = 'r1'").first()
    assert (back.depth, back.model, back.absent, back.rmse) == (3, ONE[1], None, 0.1 + 0.2)


def test_unknown_kind_and_empty_registry(spark):
    with pytest.raises(ValueError, match="no such kinds"):
        entries(spark, [ONE], 1, artifact=["model"])
    assert R.pivot_runs(spark.createDataFrame([], R.ENTRIES), COLUMNS).collect() == []
    assert R.run_maps(spark.createDataFrame([], R.ENTRIES)).collect() == []
    assert R.last_entries(entries(spark, [TWO], 1)).where(F.col("kind") != "metric").count() == 0
