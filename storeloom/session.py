"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


# HotSpot does not JIT-compile methods above 8000 bytes of bytecode. The wide
# text-typing stages generate whole-stage methods larger than that; with
# Spark's default limit (65535) they would run as interpreted bytecode.
# At 8000 Spark falls back to per-operator generated code, which is compiled.
JIT_METHOD_LIMIT = 8000


# Most bytes of a scan's task. Staged text and typed rows take some ten times
# their compressed Parquet size in a sort, so Spark's default (128 MB) would give
# a task more than its share of an executor's memory, and few tasks.
SCAN_BYTES = 16 << 20


def _bytes(size: str) -> int:
    """A size as Spark's settings write it (``16m``, ``134217728b``)."""
    digits, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", size.strip().lower()).groups()
    return int(digits) << 10 * " kmgt".index(unit or " ")


def tune(spark: SparkSession) -> SparkSession:
    """Settings the library's plans rely on; call on a cluster session too."""
    if _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")) > SCAN_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(SCAN_BYTES))
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(JIT_METHOD_LIMIT))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "storeloom") -> SparkSession:
    """A local-mode session for tests and the bench (cluster jobs bring their own)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.codegen.hugeMethodLimit", str(JIT_METHOD_LIMIT))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session (tests, bench) gets a folder under
    ``/tmp``; on a cluster, whose executors share no local folder, this raises.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = os.path.join("/tmp", f"storeloom-checkpoints-{os.getpid()}")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


# Spark's own setting: an execution's shuffle files go when it ends, not when the
# driver happens to collect its plan.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FREEING: dict[str, list] = {}  # session -> [writes under way, the setting before them]
_FREEING_LOCK = threading.Lock()

#: Codec of the library's Parquet files.
CODEC = "zstd"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """The shuffle files of the plans that are run in here go as soon as each has ended.

    For writes and counts whose plan isn't run again: what they leave behind would
    add up to several times the tables. The session's setting is put back after the
    last of concurrent writes, so a caller's own frames keep their shuffles.
    """
    key = spark._jsparkSession.sessionUUID()
    with _FREEING_LOCK:
        under_way = _FREEING.setdefault(key, [0, spark.conf.get(_CLEANUP, "false")])
        under_way[0] += 1
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _FREEING_LOCK:
            under_way[0] -= 1
            if not under_way[0]:
                spark.conf.set(_CLEANUP, _FREEING.pop(key)[1])


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables in the shared checkpoint folder; it goes when the driver's JVM ends."""
    root = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return root


@contextmanager
def passing_folder(spark: SparkSession, name: str):
    """A ``scratch_folder`` for tables that nothing reads afterwards: it goes at the end of the block."""
    root = scratch_folder(spark, name)
    try:
        yield root
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
