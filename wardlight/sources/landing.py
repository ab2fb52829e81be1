"""Incremental landing: only files that were not landed before are read.

A target holds ``data/run=…`` (typed rows, each with the file it came from) and
``manifest/batch=…`` (one row per landed file: size, time, rows, digest of its rows). A run
lists the source, leaves out files whose path, size and time the manifest has, writes the
others under a run of its own, and then enters them as the next batch by a rename that the
file system refuses where another writer took that number. A run that is torn before has left
rows that no manifest names: they are never read, and the next run lands its files whole.

A file that changed is landed anew, and its newest version is the one that is read. A file
without rows is entered too, so it is not looked at again. A file that leaves the source stays
landed. Paths pass through the driver, where Spark holds a source's listing in any case.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight import schema as S
from wardlight.session import drop_scratch, rename_new
from wardlight.sources.files import CORRUPT, read_raw_csv

FILE, RUN = "source_file", "run"
MANIFEST = (
    "source_file string, size long, modified timestamp, landed_rows long, corrupt_rows long, digest string, "
    "run string, batch long"
)
ATTEMPTS = 100


class LandingConflict(RuntimeError):
    """Another run landed one of the same files first."""


def _exists(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def list_files(spark: SparkSession, source: str, pattern: str = "*.csv*") -> DataFrame:
    """Files at any depth below the source with size and time; nothing of them is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(source)
        .select(
            "path",
            F.col("_metadata.file_path").alias(FILE),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
    )


def manifest(spark: SparkSession, target: str) -> DataFrame:
    """Every landed file of every batch."""
    if not _exists(spark, f"{target}/manifest"):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).option("basePath", f"{target}/manifest").parquet(f"{target}/manifest")


def live_files(spark: SparkSession, target: str) -> DataFrame:
    """The newest landed version of each file."""
    fields = [c.split()[0] for c in MANIFEST.split(", ")]
    newest = F.max(F.struct("batch", *[c for c in fields if c not in ("batch", FILE)])).alias("newest")
    return manifest(spark, target).groupBy(FILE).agg(newest).select(FILE, "newest.*")


def repeated_files(spark: SparkSession, target: str) -> DataFrame:
    """Contents landed under more than one name: rows, digest and the names."""
    return (
        live_files(spark, target)
        .filter("landed_rows > 0")
        .groupBy("landed_rows", "digest")
        .agg(F.array_sort(F.collect_list(FILE)).alias("files"))
        .filter(F.size("files") > 1)
    )


def _measured(spark: SparkSession, folder: str, kinds: T.StructType, found: DataFrame, run: str) -> DataFrame:
    """A manifest row per file of the run, counted from what was written. The digest takes the
    sum and the exclusive or of the rows' hashes, so the order of rows does not matter."""
    columns = [f.name for f in kinds if f.name != FILE]
    counted = (
        spark.read.schema(kinds)
        .parquet(folder)
        .select(FILE, CORRUPT, F.xxhash64(*columns).alias("h"))
        .groupBy(FILE)
        .agg(
            F.count(F.lit(1)).alias("landed_rows"),
            F.count(CORRUPT).alias("corrupt_rows"),
            F.concat_ws(":", F.hex(F.bit_xor("h")), F.hex(F.sum(F.pmod("h", F.lit(2**31 - 1))))).alias("digest"),
        )
    )
    return found.join(counted, FILE, "left").select(
        FILE, "size", "modified",
        F.coalesce("landed_rows", F.lit(0)).alias("landed_rows"),
        F.coalesce("corrupt_rows", F.lit(0)).alias("corrupt_rows"),
        F.coalesce("digest", F.lit("")).alias("digest"),
        F.lit(run).alias(RUN),
    )


def _commit(spark: SparkSession, target: str, staged: str, names: list[str], seen: int) -> int:
    """Enter a staged manifest under the next number; fail if a batch since ``seen`` has its files."""
    spark._jvm.org.apache.hadoop.fs.Path(staged).getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(
        spark._jvm.org.apache.hadoop.fs.Path(f"{target}/manifest")
    )
    for _ in range(ATTEMPTS):
        newest = manifest(spark, target).agg(F.max("batch")).first()[0] or 0
        if newest > seen:
            mine = spark.createDataFrame([(n,) for n in names], f"{FILE} string")
            if manifest(spark, target).filter(F.col("batch") > seen).join(mine, FILE, "left_semi").take(1):
                raise LandingConflict("another run landed the same files")
        if rename_new(spark, staged, f"{target}/manifest/batch={newest + 1}"):
            return newest + 1
    raise LandingConflict(f"no free batch in {ATTEMPTS} attempts")


def land_new(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Land the files that are new or changed. One row: batch (NULL where there was nothing to
    land), n_files, landed_rows, corrupt_rows."""
    seen = manifest(spark, target).agg(F.max("batch")).first()[0] or 0
    known = live_files(spark, target).select(FILE, "size", "modified")
    fresh = list_files(spark, source).join(known, [FILE, "size", "modified"], "left_anti").collect()
    report = "batch long, n_files long, landed_rows long, corrupt_rows long"
    if not fresh:
        return spark.createDataFrame([(None, 0, 0, 0)], report)
    run = f"r{uuid.uuid4().hex}"
    folder, staged = f"{target}/data/{RUN}={run}", f"{target}/staged/{run}"
    # One read per folder, as files of one folder have one header: names in the driver, no data.
    rows = read_raw_csv(spark, [r["path"] for r in fresh], keep_corrupt=True)
    named = S.normalize_columns(rows.withColumn(FILE, F.col("_metadata.file_path")))
    named.write.parquet(folder)
    found = spark.createDataFrame([(r[FILE], r["size"], r["modified"]) for r in fresh], f"{FILE} string, size long, modified timestamp")
    _measured(spark, folder, named.schema, found, run).coalesce(1).write.parquet(staged)
    sums = spark.read.parquet(staged).agg(
        F.count(F.lit(1)), F.sum("landed_rows"), F.sum("corrupt_rows")
    ).first()
    batch = _commit(spark, target, staged, [r[FILE] for r in fresh], seen)
    return spark.createDataFrame([(batch, *sums)], report)


def read_landed(spark: SparkSession, target: str) -> DataFrame:
    """The rows of every file's newest landed version, with the file they came from. Rows meet
    the manifest by run and file; runs that no manifest names are not scanned where Spark prunes
    partitions by that join, and give no rows in any case."""
    kinds = T.StructType(
        [T.StructField(S.normalize_name(f.name), f.dataType) for f in S.RAW_SCHEMA]
        + [T.StructField(CORRUPT, T.StringType()), T.StructField(FILE, T.StringType()), T.StructField(RUN, T.StringType())]
    )
    if not _exists(spark, f"{target}/data"):
        return spark.createDataFrame([], kinds)
    rows = spark.read.schema(kinds).option("basePath", f"{target}/data").parquet(f"{target}/data")
    return rows.join(live_files(spark, target).select(RUN, FILE), [RUN, FILE], "left_semi")


def drop_torn(spark: SparkSession, target: str) -> int:
    """Remove the rows of runs that no manifest names; only while no run is at work."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/data")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return 0
    named = {r[RUN] for r in manifest(spark, target).select(RUN).distinct().collect()}
    runs = [s.getPath().toString() for s in system.listStatus(path)]
    torn = [r for r in runs if r.rsplit(f"{RUN}=", 1)[-1] not in named]
    drop_scratch(spark, torn)
    return len(torn)
