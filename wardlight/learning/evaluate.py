"""Predictions of fitted models, compared in one report, and the champion's storage."""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight import schema as S
from wardlight.learning.models import load_model, save_model
from wardlight.operators.metrics import (
    MODEL_ORDER,
    champion,
    comparison_report,
    enforce_metrics,
    in_report_order,
)
from wardlight.session import materialize, scratch_path
from wardlight.sources.files import write_report_csv


def predict(model: Any, df: DataFrame, label: str = S.TARGET_COLUMN) -> DataFrame:
    """Id (if any), label, prediction and positive-class scores of every row.

    ``score`` is the model's raw one, which the ROC curve is drawn from: a decision
    tree's raw scores (its leaves' row counts) order rows otherwise than its
    probabilities do.
    """
    predicted = model.transform(df)
    kept = [c for c in ("encounter_id",) if c in df.columns]
    return predicted.select(
        *kept,
        F.col(label).alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("rawPrediction")[1].alias("score"),
        vector_to_array("probability")[1].alias("probability"),
    )


def timed_predictions(
    models: dict[str, Any], test: DataFrame, label: str = S.TARGET_COLUMN
) -> tuple[DataFrame, dict[str, float]]:
    """All models' predictions as one stored table, and the seconds each took.

    The timed step is the write of the predictions: it runs every row through the
    model, which a count of the same rows does not, and all figures read its files
    instead of predicting again.
    """
    spark = test.sparkSession
    parts, seconds = [], {}
    for name, model in models.items():
        path = scratch_path(spark, f"predictions-{name}")
        predictions = predict(model, test, label).withColumn("model", F.lit(name))
        start = time.perf_counter()
        predictions.write.parquet(path)
        seconds[name] = time.perf_counter() - start
        parts.append(spark.read.schema(predictions.schema).parquet(path))
    return reduce(DataFrame.unionByName, parts), seconds


def evaluate_models(
    models: dict[str, Any] | str,
    test: DataFrame,
    records: dict[str, dict[str, Any]] | None = None,
    label: str = S.TARGET_COLUMN,
    names: Sequence[str] = tuple(MODEL_ORDER),
    csv: str | None = None,
    complete: bool = False,
) -> DataFrame:
    """Comparison report of fitted models, or of those stored under a folder; also
    written as CSV where a path is given. ``complete`` refuses a set that lacks one of
    ``names``; without test rows every model has a row of zeros."""
    if isinstance(models, str):
        models = {name: load_model(name, f"{models}/{name}") for name in names}
    elif not isinstance(models, dict):
        raise TypeError(f"need models by name or their folder, got {type(models).__name__}")
    missing = [name for name in names if name not in models]
    if complete and missing:
        raise ValueError(f"missing models: {missing}")
    ordered = {name: models[name] for name in names if name in models}
    predictions, seconds = timed_predictions(ordered, test, label)
    known = {
        name: {
            "train_rows": 0,
            "training_time_seconds": 0.0,
            "feature_dimension": model.numFeatures,
            **{
                k: v
                for k, v in (records or {}).get(name, {}).items()
                if k in ("train_rows", "training_time_seconds", "feature_dimension")
            },
            "prediction_time_seconds": round(seconds[name], 3),
        }
        for name, model in ordered.items()
    }
    # One row per model: storing it saves computing it for the check and the caller.
    report = materialize(comparison_report(predictions, known=known), "report")
    enforce_metrics(report)
    ordered_report = in_report_order(report, names)
    if csv:
        write_report_csv(ordered_report, csv)
    return ordered_report


def evaluate_model(
    model: Any,
    test: DataFrame,
    name: str,
    record: dict[str, Any] | None = None,
    label: str = S.TARGET_COLUMN,
) -> DataFrame:
    """The report row of one fitted model."""
    return evaluate_models({name: model}, test, {name: record or {}}, label, [name])


def store_champion(
    models: dict[str, Any],
    report: DataFrame,
    folder: str,
    metric: str = "f1",
    settings: dict[str, dict[str, Any]] | None = None,
    signature: str = "",
) -> DataFrame:
    """Store the best model under ``folder/champion`` with a one-row description."""
    spark: SparkSession = report.sparkSession
    best = champion(report, metric)
    name = best.first()["model"]
    path = f"{folder}/champion/model"
    save_model(models[name], path)
    described = best.withColumns(
        {
            "selected_by": F.lit(metric),
            "settings": F.lit(json.dumps((settings or {}).get(name, {}), sort_keys=True)),
            "signature": F.lit(signature),
            "path": F.lit(path),
        }
    )
    described.coalesce(1).write.mode("overwrite").parquet(f"{folder}/champion/metadata")
    return spark.read.parquet(f"{folder}/champion/metadata")


def load_champion(spark: SparkSession, folder: str) -> tuple[Any, DataFrame]:
    metadata = spark.read.parquet(f"{folder}/champion/metadata")
    row = metadata.first()
    return load_model(row["model"], row["path"]), metadata
