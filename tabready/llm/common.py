"""Helpers that several operators share."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import gc
import os
import shutil
import tempfile
import time
import uuid
import weakref
import zipfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabready.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new path under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"


#: Seconds between two collections that ``written`` asks for, and when the last was.
COLLECT_SECONDS, _collected = 8.0, 0.0

#: Folders that ``written`` tables are read from, by their plan's DataFrame.
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def written(df: DataFrame, kind: str, *used: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and scan it back: lineage ends here,
    and a lost executor costs a re-read, not a re-run.

    ``used`` are written tables of which this one was the last reader: their
    folders go.  Shuffle files go when the driver's JVM collects the plans that
    made them, which may be long after; asking for a collection here, though not
    after every short step, lets the disk of finished steps serve the next ones."""
    global _collected
    spark, schema = df.sparkSession, df.schema
    path = scratch_path(spark, kind)
    df.write.mode("error").parquet(path)
    del df
    for table in used:
        discard(table)
    if time.monotonic() - _collected > COLLECT_SECONDS:
        gc.collect()
        spark._jvm.System.gc()
        _collected = time.monotonic()
    out = spark.read.schema(schema).parquet(path)
    _PATHS[out] = path
    return out


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """Python workers meanwhile get so many rows at once at most.  For rows that
    hold whole texts: a batch is in memory several times, as queued rows and as
    Arrow on the JVM's side, as Arrow and as objects on Python's."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def discard(table: DataFrame) -> None:
    """Delete the folder of a written table that nothing reads any more."""
    path = _PATHS.pop(table, None)
    if path is not None:
        spark = table.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors' Python workers, once per application,
    as they need not share the driver's import path."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # the driver serves the file as long as the application runs
    folder = os.path.realpath(tempfile.mkdtemp(prefix="tabready-package-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, f"tabready-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for at, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(at, name)
                    z.write(full, os.path.join("tabready", os.path.relpath(full, package)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def on_executors(step: Callable) -> Callable:
    """A query or stage whose tasks import the package."""
    @functools.wraps(step)
    def run(spark: SparkSession, *args):
        ship(spark)
        return step(spark, *args)

    return run


def release_memory() -> None:
    """Hand free memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def releasing(step: Callable) -> Callable:
    """An iterator function of a task that hands free memory back to the system
    when it ends: Python workers live on, and their allocators keep the most
    that any task before needed."""
    @functools.wraps(step)
    def run(batches):
        try:
            yield from step(batches)
        finally:
            release_memory()

    return run


def row_key(id_col: str, text_col: str):
    """128 bits that name a row by its id and its text (null counts as empty).
    Rows that share it are equal in both, so an operator decides alike for them."""
    return F.md5(F.concat_ws("\x00", F.coalesce(F.col(id_col).cast("string"), F.lit("null")),
                             F.coalesce(F.col(text_col), F.lit("")))).alias("row_key")
