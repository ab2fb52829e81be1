"""Session settings and the shared folder intermediate tables go to."""

from __future__ import annotations

import math
import re
import tempfile
import threading
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


#: Rows of a task whose rows grow on the way, see ``deal_rows``.
ROWS_A_TASK = 25_000
#: Paths that this thread has asked for, so that a caller can drop what it no longer reads.
_asked = threading.local()


def build_session(name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution on; the cluster's own settings win elsewhere."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "snappy")
        # Building a wide plan otherwise records the caller's stack for every Column.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings for wide projections of conditions.

    The JVM never compiles a method over 8000 bytes of bytecode, and whole-stage code
    for fifty CASE columns is far longer and would run interpreted. Beyond that limit
    Spark then generates one small method per expression instead.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the cluster's shared folder.

    Only where the session names no such folder and runs in one process (tests, a
    laptop) is a local one made and set, once per session. On a cluster that is an error:
    executors would not see the driver's own folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root and not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wardlight-"))
        root = context.getCheckpointDir()
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    scratch_paths().append(path)
    return path


def scratch_paths() -> list[str]:
    """The paths given to this thread so far."""
    if not hasattr(_asked, "paths"):
        _asked.paths = []
    return _asked.paths


def drop_scratch(spark: SparkSession, paths: Sequence[str]) -> None:
    """Remove tables whose results have been stored elsewhere; absent ones do no harm."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file or folder; False, and nothing done, where the target exists."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path, no_options = hadoop.Path(source), spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    files = hadoop.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration())
    try:
        files.rename(path, hadoop.Path(target), no_options)
    except Py4JJavaError as problem:
        if "FileAlreadyExists" not in str(problem.java_exception.getClass().getName()):
            raise
        return False
    return True


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once as Parquet in the shared folder and read it back.

    For frames that several jobs read: the lineage ends at files that outlive any
    executor, and later readers prune columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def deal_rows(df: DataFrame, rows_a_task: int = ROWS_A_TASK, rows: int | None = None) -> DataFrame:
    """The frame in tasks of at most about ``rows_a_task`` rows; left as it is when it has no more.

    For rows that take far more room or time than the bytes they are read from, by which files
    are cut into tasks. Give a stored frame (its rows are counted), or ``rows`` where known.
    """
    rows = df.count() if rows is None else rows
    tasks = math.ceil(rows / rows_a_task)
    return df.repartition(tasks) if tasks > 1 else df


def shuffle_width(spark: SparkSession) -> int:
    """How many ways the cluster is set up to split a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
