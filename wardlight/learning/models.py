"""The four classifiers: settings, training, storage, cross-validation."""

from __future__ import annotations

import time
from collections.abc import Sequence
from typing import Any

from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    GBTClassificationModel,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel

from wardlight import schema as S
from wardlight.learning.boosting import PackedGBT
from wardlight.learning.features import FEATURES, fold_of
from wardlight.operators.metrics import MODEL_ORDER
from wardlight.session import deal_rows

# The parameters each classifier is compared with.
SETTINGS: dict[str, dict[str, Any]] = {
    "logistic_regression": {"maxIter": 100, "regParam": 0.01},
    "random_forest": {"numTrees": 50, "maxDepth": 8, "seed": 42},
    "decision_tree": {"maxDepth": 6, "minInstancesPerNode": 3, "seed": 42},
    "gbt": {"maxIter": 30, "maxDepth": 5, "stepSize": 0.1, "seed": 42},
}


class _WithoutSummary:
    """Fitted models without their training summary.

    A model is part of the function that scores rows, and the summary that some kinds carry
    holds the training frame; what is sent to tasks should be the model alone.
    """

    def _create_model(self, java_model):
        model = super()._create_model(java_model)
        if model.hasSummary:
            java_model.setSummary(SparkSession.active()._jvm.scala.Option.empty())
        return model


class PlainLogisticRegression(_WithoutSummary, LogisticRegression):
    pass


class PlainRandomForest(_WithoutSummary, RandomForestClassifier):
    pass


ESTIMATORS = {
    "logistic_regression": (PlainLogisticRegression, LogisticRegressionModel),
    "random_forest": (PlainRandomForest, RandomForestClassificationModel),
    "decision_tree": (DecisionTreeClassifier, DecisionTreeClassificationModel),
    "gbt": (PackedGBT, GBTClassificationModel),
}


def model_settings(name: str) -> dict[str, Any]:
    """Parameters of one classifier; KeyError on an unknown name."""
    return dict(SETTINGS[name])


def all_model_settings() -> dict[str, dict[str, Any]]:
    return {name: model_settings(name) for name in MODEL_ORDER}


def _classes(name: str):
    if name not in ESTIMATORS:
        raise ValueError(f"unknown model {name!r}; choose one of {MODEL_ORDER}")
    return ESTIMATORS[name]


def build_estimator(name: str, features: str = FEATURES, label: str = S.TARGET_COLUMN, **changed):
    """An unfitted classifier with its settings, each of which may be changed."""
    estimator, _ = _classes(name)
    return estimator(featuresCol=features, labelCol=label, **{**model_settings(name), **changed})


def train_model(name: str, train: DataFrame, **changed) -> tuple[Any, float]:
    """Fitted model and the seconds the fit took.

    Rows are dealt by their number unless the caller has cached them: trees keep every slot of a
    row in memory, so tasks cut by the size of files of sparse vectors would hold gigabytes.
    """
    if not train.is_cached:
        train = deal_rows(train)
    start = time.perf_counter()
    model = build_estimator(name, **changed).fit(train)
    return model, time.perf_counter() - start


def save_model(model: Any, path: str, overwrite: bool = True) -> None:
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def load_model(name: str, path: str) -> Any:
    return _classes(name)[1].load(path)


def train_all_models(
    train: DataFrame,
    test: DataFrame | None = None,
    folder: str | None = None,
    names: Sequence[str] = tuple(MODEL_ORDER),
) -> tuple[dict[str, Any], dict[str, dict[str, Any]]]:
    """Fit every classifier on the same rows; return models and a record of each.

    Give ``train`` as a stored table (``session.materialize``): it is dealt into tasks of a
    bounded number of rows and cached for the many passes of the fits, and a lost executor reads its part again instead of
    recomputing it. With a folder each model is stored, loaded back and tried on
    a few test rows.
    """
    train_rows = train.count()
    train = deal_rows(train, rows=train_rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        test_rows = test.count() if test is not None else 0
        models, records = {}, {}
        for name in names:
            model, seconds = train_model(name, train)
            record = {
                "model": name,
                "estimator": type(model).__name__.replace("Model", ""),
                "settings": model_settings(name),
                "train_rows": train_rows,
                "test_rows": test_rows,
                "feature_dimension": model.numFeatures,
                "training_time_seconds": round(seconds, 3),
                "path": None,
            }
            if folder:
                record["path"] = f"{folder}/{name}"
                save_model(model, record["path"])
                model = load_model(name, record["path"])
                if test is not None:
                    model.transform(test.limit(10)).select("prediction").collect()
            models[name], records[name] = model, record
        return models, records
    finally:
        train.unpersist()


def cross_validate(
    train: DataFrame,
    name: str,
    grid: dict[str, Sequence[Any]],
    folds: int = 3,
    seed: int = 42,
    parallelism: int = 2,
    metric: str = "areaUnderROC",
    **changed,
) -> tuple[CrossValidatorModel, DataFrame]:
    """K-fold search over a parameter grid; the fitted search and a row per setting.

    Folds come from a hash of the encounter id, so a row is in the same fold whenever
    its partition is computed.
    """
    estimator = build_estimator(name, **changed)
    builder = ParamGridBuilder()
    for parameter, values in grid.items():
        builder = builder.addGrid(estimator.getParam(parameter), list(values))
    maps = builder.build()
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=maps,
        evaluator=BinaryClassificationEvaluator(labelCol=S.TARGET_COLUMN, metricName=metric),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    )
    numbered = train.withColumn("fold", fold_of(train, folds, seed=seed))
    fitted = search.fit(numbered)
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in setting.items()), float(mean), float(spread))
        for setting, mean, spread in zip(maps, fitted.avgMetrics, fitted.stdMetrics)
    ]
    return fitted, train.sparkSession.createDataFrame(
        rows, "setting string, mean_metric double, std_metric double"
    )
