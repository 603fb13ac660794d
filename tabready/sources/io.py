"""Scans, sinks and dataset identity.

Writes go to new, versioned directories: an input is never overwritten in
place (H15), and a written table is the unit that later stages scan with
pushdown and that survives executor loss.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabready.contract import normalize_column_name

FINGERPRINT_MOD = 1 << 20


# ---- S13 / S1-S4: reads ---------------------------------------------------------

def require_columns(columns: Sequence[str]) -> None:
    """Non-empty header without duplicates (after name normalisation)."""
    if not columns:
        raise ValueError("The input has no columns.")
    norm = [normalize_column_name(c) for c in columns]
    dupes = sorted({c for c in norm if norm.count(c) > 1})
    if dupes:
        raise ValueError(f"Duplicate columns in the header: {dupes}")


def read_csv_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Header CSV with every column typed as string (the parse operators
    type them); pass ``columns`` to skip reading the header line."""
    if columns is None:
        columns = spark.read.option("header", True).csv(path).columns
    require_columns(columns)
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_parquet_table(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Parquet with column pruning (and predicate pushdown by later filters)."""
    df = spark.read.parquet(path)
    df = df.select(*columns) if columns else df
    return df


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """S3: a managed table."""
    return spark.table(name)


# The fields of run-summary documents.
RUN_SUMMARY_SCHEMA = T.StructType([
    T.StructField("experiment_id", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("feature_set", T.StringType()),
    T.StructField("feature_count", T.LongType()),
    T.StructField("best_model", T.StringType()),
    T.StructField("validation_rmse", T.DoubleType()),
    T.StructField("test_rmse", T.DoubleType()),
    T.StructField("test_mae", T.DoubleType()),
    T.StructField("test_r2", T.DoubleType()),
    T.StructField("training_wall_clock_seconds", T.DoubleType()),
    T.StructField("prediction_seconds", T.DoubleType()),
    T.StructField("model_features", T.ArrayType(T.StringType())),
    T.StructField("top_five_features", T.ArrayType(T.StringType())),
    T.StructField("package_versions", T.MapType(T.StringType(), T.StringType())),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("recorded", T.LongType()),
])


def read_run_registry(spark: SparkSession, glob: str, schema: T.StructType = RUN_SUMMARY_SCHEMA, lines: bool = False) -> DataFrame:
    """Many run-summary JSON documents as one table (explicit schema, no
    inference); ``lines`` reads appended records (S9), one per line."""
    return spark.read.schema(schema).option("multiLine", not lines).json(glob)


def append_run_records(runs: DataFrame, path: str, recorded: int, tags: Mapping[str, str] | None = None) -> None:
    """Append one JSON record per run to the registry at ``path``.
    ``recorded`` orders records of a run (a time or a version); earlier ones stay."""
    pairs = [F.lit(x) for kv in (tags or {}).items() for x in kv]
    known = {f.name for f in RUN_SUMMARY_SCHEMA.fields}
    (runs.withColumn("tags", F.create_map(*pairs)).withColumn("recorded", F.lit(recorded))
     .select(*[c for c in [*runs.columns, "tags", "recorded"] if c in known]).write.mode("append").json(path))


def latest_run_records(registry: DataFrame, run: Sequence[str]) -> DataFrame:
    """The last record of each run: one aggregate per ``run`` key."""
    last = F.max_by(F.struct(*registry.columns), "recorded").alias("_r")
    return registry.groupBy(*run).agg(last).select("_r.*")


# ---- S5-S8, S10, S11: writes ------------------------------------------------------

def versioned_path(base: str, name: str) -> str:
    return os.path.join(base, name, f"v-{uuid.uuid4().hex}")


def write_table(df: DataFrame, base: str, name: str, formats: Sequence[str] = ("parquet",)) -> dict[str, str]:
    """Write a new version of a table as Parquet (and CSV); returns paths."""
    out = {}
    for fmt in formats:
        path = versioned_path(base, f"{name}.{fmt}")
        w = df.write.mode("error")
        (w.option("header", True).csv(path) if fmt == "csv" else w.format(fmt).save(path))
        out[fmt] = path
    return out


def write_splits(df: DataFrame, base: str, name: str, split_col: str = "data_split") -> str:
    """One directory per split (``partitionBy``), so reading one split is
    partition-pruned."""
    path = versioned_path(base, name)
    df.write.mode("error").partitionBy(split_col).parquet(path)
    return path


def save_results_as_tables(tables: Mapping[str, DataFrame], database: str | None = None) -> list[str]:
    """Result tables to the catalog, replacing previous versions."""
    names = []
    for name, df in tables.items():
        full = f"{database}.{name}" if database else name
        df.write.mode("overwrite").saveAsTable(full)
        names.append(full)
    return names


def write_report_table(df: DataFrame, base: str, name: str, fmt: str = "json") -> str:
    """An already-aggregated report table as one JSON/CSV file."""
    path = versioned_path(base, f"{name}.{fmt}")
    w = df.repartition(1).write.mode("error")
    (w.option("header", True).csv(path) if fmt == "csv" else w.json(path))
    return path


def save_predictions(preds: DataFrame, base: str, name: str = "predictions") -> str:
    """``(model, split, id, actual, predicted, residual)`` as Parquet."""
    path = versioned_path(base, name)
    preds.withColumn("residual", F.col("actual") - F.col("predicted")).write.mode("error").partitionBy(
        "model").parquet(path)
    return path


def save_model(model: PipelineModel, base: str, name: str) -> str:
    """S11."""
    path = versioned_path(base, name)
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """S11."""
    return PipelineModel.load(path)


# ---- S12: content identity -----------------------------------------------------------

def row_hash(columns: Sequence[str]):
    """A 60-bit integer per row from md5 over the row as JSON (type-aware,
    no separator ambiguity, expressible in SQL)."""
    j = F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})
    return F.conv(F.substring(F.md5(j), 1, 15), 16, 10).cast("bigint")


def dataset_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Order-insensitive identity of a dataset version: row count,
    XOR of row hashes and the sum of row hashes modulo 2^20 (the sum stays
    below 2^63 up to 10^12 rows).  Equal content gives equal fingerprints
    whatever the partitioning."""
    cols = list(columns) if columns else df.columns
    h = row_hash(cols)
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.bit_xor(h).alias("xor_hash"),
        F.sum(h % FINGERPRINT_MOD).alias("sum_hash"),
    )
