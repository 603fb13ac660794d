"""Validation of modelling tables and quality gates.

Every check is a conditional count inside one aggregate per table; the
results are small tables (one row per check) that union into an
expectation table and reduce to one gate status.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabready.functions.arithmetic import long_form
from tabready.functions.cleaning import present
from tabready.sources.io import dataset_fingerprint

EXPORT_LABELS = ("train", "validate", "test")


def _checks(agg: DataFrame, names: Sequence[str]) -> DataFrame:
    return long_form(agg, {n: n for n in names}, "check_name", "violations").withColumn(
        "status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))


def validate_modeling_table(
    df: DataFrame, identifier: str, target: str, features: Sequence[str], prohibited: Sequence[str] = (),
) -> DataFrame:
    """F8: required columns present, non-empty, target and identifier
    present in every row, no leaking feature.  Schema problems raise before
    any job; row problems come back as violation counts."""
    missing = sorted(set([identifier, target, *features]) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    leaking = sorted(set(features) & set([identifier, target, *prohibited]))
    if leaking:
        raise ValueError(f"features that leak the target or name the row: {leaking}")
    agg = df.agg(
        F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("bigint").alias("non_empty"),
        F.count_if(present(df, target).isNull()).alias("target_present"),
        F.count_if(present(df, identifier).isNull()).alias("identifier_present"),
    )
    return _checks(agg, ["non_empty", "target_present", "identifier_present"])


def validate_split_export(
    df: DataFrame, identifier: str, target: str, split_col: str = "data_split",
    expected: Sequence[str] = EXPORT_LABELS,
) -> DataFrame:
    """F8's row checks plus identifiers in several splits, duplicate
    identifiers and the exact label set, in two aggregates."""
    per_id = df.groupBy(identifier).agg(
        F.count(F.lit(1)).alias("_n"), F.count_distinct(split_col).alias("_s"),
        F.count_if(present(df, target).isNull()).alias("_t"),
    )
    labels = df.groupBy(split_col).agg(F.count(F.lit(1)).alias("_rows"))
    lab = labels.agg(
        (F.count_if(~F.col(split_col).isin(*expected) | F.col(split_col).isNull())
         + F.lit(len(expected)) - F.count_if(F.col(split_col).isin(*expected))).alias("label_set"),
    )
    agg = per_id.agg(
        F.when(F.sum("_n").isNull(), 1).otherwise(0).cast("bigint").alias("non_empty"),
        F.coalesce(F.sum("_t"), F.lit(0)).alias("target_present"),
        F.coalesce(F.sum(F.when(F.col(identifier).isNull(), F.col("_n"))), F.lit(0)).alias("identifier_present"),
        F.count_if(F.col("_s") > 1).alias("identifiers_in_multiple_splits"),
        F.count_if(F.col(identifier).isNotNull() & (F.col("_n") > 1)).alias("duplicate_identifiers"),
    )
    names = ["non_empty", "target_present", "identifier_present", "identifiers_in_multiple_splits",
             "duplicate_identifiers"]
    return _checks(agg, names).unionByName(_checks(lab, ["label_set"]))


def row_count_check(df: DataFrame, table: str, minimum: int) -> DataFrame:
    """Q1 kind "rows >= minimum": one check row for a table."""
    return df.agg(F.count(F.lit(1)).alias("_n")).select(
        F.lit(table).alias("table_name"),
        F.lit(f"rows >= {minimum}").alias("check_name"),
        F.when(F.col("_n") >= minimum, "PASS").otherwise("FAIL").alias("status"),
        F.concat(F.lit("rows="), F.col("_n").cast("string")).alias("details"),
    )


def status_check(df: DataFrame, table: str, status_col: str = "status", warn_values: Sequence[str] = ()) -> DataFrame:
    """Q1 kind "status == PASS": FAIL if any row fails, WARN for warning values."""
    return df.agg(
        F.count_if(F.col(status_col) == "FAIL").alias("_f"),
        F.count_if(F.col(status_col).isin(*warn_values) if warn_values else F.lit(False)).alias("_w"),
        F.count(F.lit(1)).alias("_n"),
    ).select(
        F.lit(table).alias("table_name"),
        F.lit(f"{status_col} == PASS").alias("check_name"),
        F.when(F.col("_f") > 0, "FAIL").when(F.col("_w") > 0, "WARN").otherwise("PASS").alias("status"),
        F.concat(F.lit("failed="), F.col("_f").cast("string"), F.lit(" of "), F.col("_n").cast("string")).alias(
            "details"),
    )


#: Files that a listing may hold: artifacts are reports and models, not data.
MAX_ARTIFACTS = 20_000


def artifact_listing(spark: SparkSession, base: str, tables: Sequence[str] = ()) -> DataFrame:
    """``artifact, kind, bytes``: every file under ``base`` on any file system of
    the session, named by its path below it, and those of the named catalog tables
    that exist (their size is that of their plan's statistics).

    Only names and sizes are read; a folder that isn't there holds no artifacts.  A
    folder of more than ``MAX_ARTIFACTS`` files is an error: list a part of it.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rows = [(t, "table", int(str(spark.table(t)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())))
            for t in tables if spark.catalog.tableExists(t)]
    if fs.exists(path):
        root = fs.makeQualified(path).toUri().getPath().rstrip("/") + "/"
        files = fs.listFiles(path, True)  # recursive, read in pages
        while files.hasNext():
            if len(rows) >= MAX_ARTIFACTS:
                raise ValueError(f"{base} holds more than {MAX_ARTIFACTS} artifacts")
            status = files.next()
            rows.append((status.getPath().toUri().getPath().removeprefix(root), "file", status.getLen()))
    return spark.createDataFrame(rows, "artifact string, kind string, bytes long")


def check_exists(expected: DataFrame, listing: DataFrame) -> DataFrame:
    """Q1 kind "exists": a row per expected artifact (``artifact, kind``).  A
    folder exists if it holds a file; its size is that of its files.  FAIL if it
    isn't there, WARN if it is empty."""
    parts = F.split("artifact", "/")
    # a file stands for itself and for the folders above it
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    found = listing.select("kind", "bytes", F.explode(F.when(F.col("kind") == "file", above).otherwise(F.array("artifact"))).alias("artifact"))
    sizes = found.groupBy("artifact", "kind").agg(F.sum("bytes").alias("_bytes"), F.count(F.lit(1)).alias("_files"))
    wanted = expected.select(F.regexp_replace("artifact", "/+$", "").alias("artifact"), "kind").distinct()
    return wanted.join(sizes, ["artifact", "kind"], "left").select(
        F.col("artifact").alias("table_name"), F.concat(F.col("kind"), F.lit(" exists")).alias("check_name"),
        F.when(F.col("_files").isNull(), "FAIL").when(F.col("_bytes") == 0, "WARN").otherwise("PASS").alias("status"),
        F.when(F.col("_files").isNull(), "absent").when(F.col("_bytes") == 0, "empty").otherwise("present").alias("details"))


def expectation_table(checks: Sequence[DataFrame]) -> DataFrame:
    """Q1: one row per check (table, check, PASS/WARN/FAIL, details)."""
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def gate_status(expectations: DataFrame) -> DataFrame:
    """Q2: FAIL if any check failed, PASS_WITH_WARNINGS if any warned, else PASS."""
    return expectations.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
        F.count_if(F.col("status") == "WARN").alias("warnings"),
    ).withColumn(
        "gate_status",
        F.when(F.col("failed") > 0, "FAIL").when(F.col("warnings") > 0, "PASS_WITH_WARNINGS").otherwise("PASS"),
    )


def evidence_manifest(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q3: one row per table version: name, rows and content fingerprint."""
    parts = [dataset_fingerprint(df).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drop_null_metric_rows(lb: DataFrame, columns: Sequence[str]) -> DataFrame:
    """ignore models without timing."""
    return lb.dropna(subset=list(columns))

