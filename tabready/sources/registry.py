"""The run registry as typed key-value entries.

One row per ``(run_id, kind, key)`` and recording: ``value`` is JSON text and
``value_type`` the Spark type it was written from, so numbers, lists and maps
come back as they were.  Entries are only ever appended, one folder per kind; the
entry recorded last wins for its key (among equals the larger text), and a
recorded null takes the key away.  Reading back is one aggregate per run: each
wanted column is the last entry of its key, so keys that a run never wrote are
null and no pivot pass is needed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabready.sources.io import versioned_path

KINDS = ("param", "metric", "tag", "config", "version")
ENTRIES = "run_id string, kind string, key string, value string, value_type string, recorded long"
ENTRY_KEY = ["run_id", "kind", "key"]
#: Columns that a pivot may make when it finds the keys by itself.
MAX_FOUND_KEYS = 2_000


def _entry(kind: str, key: Column, value: Column, value_type: str) -> Column:
    text = F.when(value.isNotNull(), F.to_json(F.struct(value.alias("v"))))
    return F.struct(F.lit(kind).alias("kind"), key.alias("key"), text.alias("value"), F.lit(value_type).alias("value_type"))


def _map_entries(kind: str, column: str, value_type: str) -> Column:
    return F.transform(F.map_entries(F.col(column)), lambda e: _entry(kind, e["key"].cast("string"), e["value"], value_type))


def run_entries(runs: DataFrame, run_id: str | Column, recorded: int | Column, **kinds: Sequence[str]) -> DataFrame:
    """Long form of one row per run.  Each kind names columns; a map column
    gives an entry per key of the map, any other an entry under its own name.

    ``run_entries(runs, "run_id", 1, param=["feature_count"], metric=["rmse"], version=["package_versions"])``
    """
    unknown = sorted(set(kinds) - set(KINDS))
    if unknown:
        raise ValueError(f"no such kinds of entries: {unknown}")
    types = {f.name: f.dataType for f in runs.schema.fields}
    single, maps = [], []
    for kind, columns in kinds.items():
        for c in columns:
            if types[c].typeName() == "map":
                maps.append(_map_entries(kind, c, types[c].valueType.simpleString()))
            else:
                single.append(_entry(kind, F.lit(c), F.col(c), types[c].simpleString()))
    parts = ([F.array(*single)] if single else []) + [F.coalesce(m, F.array().cast("array<struct<kind:string,key:string,value:string,value_type:string>>")) for m in maps]
    run, at = (F.col(run_id) if isinstance(run_id, str) else run_id), (recorded if isinstance(recorded, Column) else F.lit(recorded))
    long = runs.select(run.cast("string").alias("run_id"), F.explode(F.concat(*parts)).alias("_e"), at.cast("long").alias("recorded"))
    return long.select("run_id", "_e.*", "recorded").select("run_id", "kind", "key", "value", "value_type", "recorded")


def append_entries(entries: DataFrame, path: str) -> None:
    """Append to the registry at ``path``; what was recorded before stays."""
    entries.write.mode("append").partitionBy("kind").parquet(path)


def read_entries(spark: SparkSession, path: str, kinds: Sequence[str] | None = None) -> DataFrame:
    """Every recording; ``kinds`` reads those folders only."""
    out = spark.read.schema(ENTRIES).parquet(path)
    return out if kinds is None else out.where(F.col("kind").isin(*kinds))


def _order() -> Column:
    return F.struct("recorded", F.coalesce("value", F.lit("")))


def last_entries(entries: DataFrame) -> DataFrame:
    """The entry recorded last of each key, without the keys that were taken away."""
    last = F.max_by(F.struct("value", "value_type", "recorded"), _order()).alias("_l")
    return entries.groupBy(*ENTRY_KEY).agg(last).select(*ENTRY_KEY, "_l.*").where("value IS NOT NULL")


def decoded(value: Column, value_type: str) -> Column:
    return F.from_json(value, f"v {value_type}")["v"]


def pivot_runs(entries: DataFrame, columns: Mapping[str, tuple[str, str, str]]) -> DataFrame:
    """One row per run; ``columns`` maps a column to ``(kind, key, type)``."""
    aggs = []
    for name, (kind, key, _) in columns.items():
        own = (F.col("kind") == kind) & (F.col("key") == key)
        # max_by leaves rows out whose order is null
        aggs.append(F.max_by("value", F.when(own, _order())).alias(name))
    wanted = F.struct("kind", "key").isin(*[F.struct(F.lit(k).alias("kind"), F.lit(x).alias("key")) for k, x in {(k, x) for k, x, _ in columns.values()}])
    # a run that wrote none of the wanted keys still has a row
    narrow = entries.withColumn("value", F.when(wanted, F.col("value")))
    wide = narrow.groupBy("run_id").agg(*aggs)
    return wide.select("run_id", *[decoded(F.col(n), t).alias(n) for n, (_, _, t) in columns.items()])


def found_columns(entries: DataFrame) -> dict[str, tuple[str, str, str]]:
    """Every key of the registry with the type it has been recorded in; text
    where the types differ.  The keys are counted before they are collected."""
    types = entries.groupBy("kind", "key").agg(F.min("value_type").alias("least"), F.max("value_type").alias("most"))
    rows = types.limit(MAX_FOUND_KEYS + 1).collect()
    if len(rows) > MAX_FOUND_KEYS:
        raise ValueError(f"the registry has over {MAX_FOUND_KEYS} keys; name the columns to read")
    return {f"{r['kind']}_{r['key']}": (r["kind"], r["key"], r["least"] if r["least"] == r["most"] else "string")
            for r in sorted(rows, key=lambda r: (KINDS.index(r["kind"]) if r["kind"] in KINDS else len(KINDS), r["key"]))}


def run_maps(entries: DataFrame, recorded: str = "last_recorded") -> DataFrame:
    """One row per run with a map per kind: ``params`` and ``tags`` as text,
    ``metrics`` as doubles, ``configs`` and ``versions`` as text."""
    def of(kind: str, as_type: str) -> Column:
        own = F.filter("_all", lambda e: e["kind"] == kind)
        pairs = F.transform(own, lambda e: F.struct(e["key"].alias("key"), (
            decoded(e["value"], "double") if as_type == "double" else _plain(e["value"], e["value_type"])).alias("value")))
        return F.map_from_entries(F.array_sort(pairs)).alias(f"{kind}s")

    last = last_entries(entries).groupBy("run_id").agg(
        F.collect_list(F.struct("kind", "key", "value", "value_type")).alias("_all"), F.max("recorded").alias(recorded))
    return last.select("run_id", recorded, *[of(k, "double" if k == "metric" else "string") for k in KINDS])


def _plain(value: Column, value_type: Column) -> Column:
    """Text as it was; anything else as its JSON."""
    return F.when(value_type == "string", decoded(value, "string")).otherwise(F.get_json_object(value, "$.v"))


def metric_history(entries: DataFrame, key: str) -> DataFrame:
    """Every recording of a metric: ``run_id, recorded, value``."""
    own = entries.where((F.col("kind") == "metric") & (F.col("key") == key) & F.col("value").isNotNull())
    return own.select("run_id", "recorded", decoded(F.col("value"), "double").alias("value"))


def compact_entries(spark: SparkSession, path: str, base: str, name: str = "runs") -> str:
    """A new version of the registry with the last entries only; returns its path."""
    new = versioned_path(base, name)
    append_entries(last_entries(read_entries(spark, path)), new)
    return new


# ---- L17 --------------------------------------------------------------------------

def trial_rows(entries: DataFrame, score: str, duration: str) -> DataFrame:
    """One row per run: the score and the duration (metrics), when it was last
    recorded, and params and metrics as JSON objects with sorted keys."""
    maps = run_maps(entries)
    return maps.select("run_id", F.col("metrics")[score].alias("score"), F.col("metrics")[duration].alias("duration"),
                       F.col("last_recorded"), F.to_json("params").alias("params_json"), F.to_json("metrics").alias("metrics_json"))


def typed_trials(trials: DataFrame, params: str, metrics: str) -> DataFrame:
    """Params and metrics read back from their JSON by a schema each, as columns."""
    out = trials.withColumns({"_p": F.from_json("params_json", "map<string,string>"), "_m": F.from_json("metrics_json", metrics)})
    fields = SparkSession.active().createDataFrame([], params).schema.fields
    cols = [F.col("_p")[f.name].try_cast(f.dataType).alias(f.name) for f in fields]
    return out.select("run_id", "score", "duration", "last_recorded", *cols, "_m.*")
