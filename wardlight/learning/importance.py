"""Global feature importance of fitted models."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlight import schema as S
from wardlight.learning.evaluate import predict
from wardlight.operators.metrics import auc
from wardlight.operators.ordered import with_previous


def slot_importance(model: Any) -> list[float]:
    """Importance per vector slot: a tree model's own, else the size of the coefficient
    (slots are scaled to unit deviation, so sizes compare)."""
    if hasattr(model, "featureImportances"):
        return [float(v) for v in model.featureImportances.toArray()]
    return [abs(float(v)) for v in model.coefficients.toArray()]


def feature_importance(
    spark: SparkSession, models: dict[str, Any], slots: Sequence[tuple[str, str]]
) -> DataFrame:
    """Ranked importance per model and feature, summed over a category's slots.

    The input is one number per vector slot and model.
    """
    rows = [
        (name, column, value)
        for name, model in models.items()
        for (column, _), value in zip(slots, slot_importance(model), strict=True)
    ]
    summed = (
        spark.createDataFrame(rows, "model string, feature string, importance double")
        .groupBy("model", "feature")
        .agg(F.sum("importance").alias("importance"))
    )
    order = W.partitionBy("model").orderBy(F.desc("importance"), "feature")
    return summed.withColumn("place", F.row_number().over(order))


def with_shuffled(df: DataFrame, column: str, key: str = "encounter_id") -> DataFrame:
    """The frame with one column's values moved between rows.

    Each row takes the value of the row before it in the order of a hash of the key,
    a fixed order that has nothing to do with the values and is cut into pieces; the
    first row keeps its own.
    """
    ordered = df.withColumns({"_order": F.xxhash64(key), "_all": F.lit(0)})
    moved = with_previous(ordered, "_all", "_order", column, "_moved")
    return moved.withColumn(column, F.coalesce("_moved", column)).select(df.columns)


def permutation_importance(
    feature_model: Any,
    model: Any,
    features: DataFrame,
    columns: Sequence[str],
    label: str = S.TARGET_COLUMN,
) -> DataFrame:
    """How much AUC a fitted model loses when one column no longer belongs to its row.

    ``features`` is a stored feature table. The curves of all columns and of the
    untouched table come from one aggregation.
    """
    frames = {"": features, **{c: with_shuffled(features, c) for c in columns}}
    tagged = [
        predict(model, feature_model.transform(frame), label)
        .select("label", "score")
        .withColumn("model", F.lit(name))
        for name, frame in frames.items()
    ]
    found = auc(reduce(DataFrame.unionByName, tagged))
    whole = found.filter("model = ''").select(F.col("auc_roc").alias("_whole"))
    order = W.partitionBy().orderBy(F.desc("auc_drop"), "feature")
    return (
        found.filter("model <> ''")
        .select(
            F.col("model").alias("feature"),
            (whole.scalar() - F.col("auc_roc")).alias("auc_drop"),
        )
        .withColumn("place", F.row_number().over(order))
    )
