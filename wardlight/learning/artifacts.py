"""Fitted pipelines with versions: what a scoring job loads to score raw rows.

An artifact is one stored ``PipelineModel`` from raw feature columns to a probability. A
folder of artifacts has a log: numbered entries, one file each, that publish a version or make
one the champion. An entry is taken by renaming a finished file to the next number, which the
file system refuses when another writer was first, so a number has one writer; promotion names
the champion it replaces and fails if that has changed.
"""

from __future__ import annotations

import json
import time
import uuid
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.errors import SchemaValidationError
from wardlight.session import rename_new

LOG_FIELDS = (
    "entry long, kind string, version long, previous long, path string, signature string, details string, at double"
)
ATTEMPTS = 100


class PromotionConflict(RuntimeError):
    """Another champion was chosen since the caller looked."""


def combine(features: PipelineModel, classifier: Any) -> PipelineModel:
    """Feature stages and classifier as one model."""
    return PipelineModel(stages=[*features.stages, classifier])


def signature_of(df: DataFrame, columns) -> str:
    """Names and types of the columns a model reads, in the order of ``columns``."""
    kinds = dict(df.dtypes)
    missing = [c for c in columns if c not in kinds]
    if missing:
        raise SchemaValidationError(f"missing columns: {missing}")
    return json.dumps([[c, kinds[c]] for c in columns])


def log_entries(spark: SparkSession, folder: str) -> DataFrame:
    """The log in order; empty for a folder without one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/log")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LOG_FIELDS)
    return spark.read.schema(LOG_FIELDS).json(f"{folder}/log").orderBy("entry")


def _append(spark: SparkSession, folder: str, make) -> dict[str, Any]:
    """Add the entry that ``make`` builds from those there are; tried anew on the next number
    whenever another writer took it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    staged = hadoop.Path(f"{folder}/staged/{uuid.uuid4().hex}")
    system = staged.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(hadoop.Path(f"{folder}/log"))
    for _ in range(ATTEMPTS):
        seen = [r.asDict() for r in log_entries(spark, folder).collect()]
        entry = {"entry": 1 + (seen[-1]["entry"] if seen else 0), "at": time.time(), **make(seen)}
        out = system.create(staged, True)
        out.write(bytearray((json.dumps(entry) + "\n").encode()))
        out.close()
        if rename_new(spark, staged.toString(), f"{folder}/log/{entry['entry']:08d}.json"):
            return entry
    raise PromotionConflict(f"no free entry in {ATTEMPTS} attempts")


def publish(spark: SparkSession, folder: str, model: PipelineModel, signature: str, details: dict[str, Any] | None = None) -> int:
    """Store a model and enter it under the next version, which is returned."""
    path = f"{folder}/models/{uuid.uuid4().hex}"
    model.write().save(path)

    def entry(seen):
        version = 1 + max((e["version"] for e in seen), default=0)
        described = json.dumps(details or {}, sort_keys=True)
        return {"kind": "publish", "version": version, "path": path, "signature": signature, "details": described}

    return _append(spark, folder, entry)["version"]


def champion_version(spark: SparkSession, folder: str) -> int | None:
    last = log_entries(spark, folder).filter("kind = 'promote'").agg(F.max_by("version", "entry")).first()
    return last[0]


def promote(spark: SparkSession, folder: str, version: int, expected: int | None) -> None:
    """Make ``version`` the champion in the place of ``expected`` (None: of none)."""

    def entry(seen):
        if not any(e["kind"] == "publish" and e["version"] == version for e in seen):
            raise ValueError(f"no version {version}")
        now = next((e["version"] for e in reversed(seen) if e["kind"] == "promote"), None)
        if now != expected:
            raise PromotionConflict(f"the champion is {now}, not {expected}")
        return {"kind": "promote", "version": version, "previous": expected}

    _append(spark, folder, entry)


def load_version(spark: SparkSession, folder: str, version: int | None = None) -> tuple[int, PipelineModel, str]:
    """Version (None: the champion), its model and its signature."""
    version = champion_version(spark, folder) if version is None else version
    found = log_entries(spark, folder).filter((F.col("kind") == "publish") & (F.col("version") == version)).first()
    if found is None:
        raise ValueError(f"no version {version} in {folder}")
    return version, PipelineModel.load(found["path"]), found["signature"]


def check_signature(df: DataFrame, signature: str) -> None:
    """Raise unless ``df`` has the columns the model was published with, in kind too."""
    kinds = dict(df.dtypes)
    wrong = [f"{c} {kinds.get(c, 'absent')} instead of {kind}" for c, kind in json.loads(signature) if kinds.get(c) != kind]
    if wrong:
        raise SchemaValidationError("; ".join(wrong))
