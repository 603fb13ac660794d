"""Session construction and lineage control.

The library never builds a cluster session itself in production code: every
operator takes the caller's ``SparkSession``.  ``local_session`` exists for
tests, the bench and the driver smoke check.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tabready") -> SparkSession:
    """A local session with the settings the tests and the bench rely on."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # the JVM doesn't compile methods over 8000 bytes; cleaning many columns makes such methods
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # local runs only: catalog tables go to a scratch warehouse, not the cwd
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tabready-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as
    is, and it must be set.  Only a local master with nothing configured
    (tests, the bench) gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        if not sc.master.startswith("local"):
            # a machine-local folder would leave checkpoints on single executors
            raise RuntimeError(f"Set {CHECKPOINT_CONF} to shared storage; checkpoints and staged tables "
                               "must survive executor loss.")
        current = tempfile.mkdtemp(prefix="tabready-ckpt-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)  # the scratch folder ends with the application
        spark.conf.set(CHECKPOINT_CONF, current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


_STAGED: dict[tuple, str] = {}


def input_version(spark: SparkSession, paths: Sequence[str]) -> tuple:
    """Modification time and size of each input, on any file system of the session."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        out.append((p, fs.getFileStatus(path).getModificationTime(), fs.getContentSummary(path).getLength()))
    return tuple(out)


def staged(spark: SparkSession, key: str, build: Callable[[], DataFrame], inputs: Sequence[str]) -> DataFrame:
    """Build a table once per application, key and version of its inputs, write
    it under the shared checkpoint folder and read it back.

    Intermediate tables that several queries reuse (the split model table,
    the long predictions table) are computed once; the written copy cuts the
    lineage, so a lost executor re-reads Parquet instead of re-running the
    upstream plan.  A rewritten input is a new version and is built anew.
    """
    memo_key = (spark.sparkContext.applicationId, key, input_version(spark, inputs))
    path = _STAGED.get(memo_key)
    if path is None:
        df = build()
        base = ensure_checkpoint_dir(spark)
        path = os.path.join(base, "staged", f"{uuid.uuid4().hex}")
        df.write.mode("error").parquet(path)
        _STAGED[memo_key] = path
    return spark.read.parquet(path)


def forget_staged(spark: SparkSession | None = None) -> None:
    """Let the next use of every staged table build it anew, and delete those of
    this application: call it when a long application has done with them."""
    spark = spark or SparkSession.getActiveSession()
    for key, path in list(_STAGED.items()):
        if spark is not None and key[0] == spark.sparkContext.applicationId:
            delete_folder(spark, path)
        del _STAGED[key]


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on any file system of the session."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
