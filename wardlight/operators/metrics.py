"""Evaluation of tagged predictions: one row per model, all models in one pass.

Input rows carry ``model``, a 0/1 label, a 0/1 prediction and a score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlight.errors import MetricValidationError
from wardlight.operators.ordered import PIECE, running_before, split_points, with_piece
from wardlight.session import materialize

# Model names in report order, and the report's columns.
MODEL_ORDER = ["logistic_regression", "random_forest", "decision_tree", "gbt"]
REPORT_COLUMNS = [
    "model", "train_rows", "test_rows", "feature_dimension",
    "accuracy", "precision", "recall", "f1", "auc_roc", "sensitivity", "specificity",
    "tp", "tn", "fp", "fn", "training_time_seconds", "prediction_time_seconds",
]
RATES = ["accuracy", "precision", "recall", "f1", "sensitivity", "specificity"]
COUNTS = ["tp", "tn", "fp", "fn"]


def confusion(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    y, p = F.col(label), F.col(prediction)
    return predictions.groupBy("model").agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def with_rates(counts: DataFrame) -> DataFrame:
    """Six rates from the four counts; 0 where a rate has nothing to divide by."""
    tp, tn, fp, fn = (F.col(c) for c in COUNTS)
    recall = _ratio(tp, tp + fn)
    return counts.withColumns(
        {
            "accuracy": _ratio(tp + tn, tp + tn + fp + fn),
            "precision": _ratio(tp, tp + fp),
            "recall": recall,
            "f1": _ratio(2 * tp, 2 * tp + fp + fn),
            "sensitivity": recall,
            "specificity": _ratio(tn, tn + fp),
        }
    )


def auc(
    predictions: DataFrame, label: str = "label", score: str = "score", pieces: int | None = None
) -> DataFrame:
    """Exact area under the ROC curve per model: the share of (positive, negative)
    pairs the score puts in order, ties counting half.

    No pairs are formed. Rows are counted per score first and the counts stored, so
    predictions are read once; negatives below a score come from a running sum split
    over pieces of the score range. With one class only, all positive gives 1 and all
    negative 0.
    """
    scored = predictions.select(
        "model", F.col(label).cast("int").alias("_y"), F.col(score).alias("_s")
    ).filter("_y IS NOT NULL AND _s IS NOT NULL")
    per_score = materialize(
        scored.groupBy("model", "_s").agg(
            F.count_if(F.col("_y") == 1).alias("_pos"), F.count_if(F.col("_y") == 0).alias("_neg")
        ),
        "score-counts",
    )
    points = split_points(per_score, "_s", pieces)
    before = W.partitionBy("model", PIECE).orderBy("_s").rowsBetween(W.unboundedPreceding, -1)
    inside = with_piece(per_score, "_s", points).withColumn(
        "_below", F.coalesce(F.sum("_neg").over(before), F.lit(0))
    )
    per_piece = inside.groupBy("model", PIECE).agg(
        F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / 2)).alias("_pairs"),
        F.sum("_pos").alias("_pos"),
        F.sum("_neg").alias("_neg"),
    )
    carried = per_piece.withColumn("_before", running_before(F.col("_neg"), "model"))
    total = carried.groupBy("model").agg(
        F.sum(F.col("_pairs") + F.col("_pos") * F.col("_before").cast("double")).alias("_pairs"),
        F.sum("_pos").cast("double").alias("_pos"),
        F.sum("_neg").cast("double").alias("_neg"),
    )
    pos, neg = F.col("_pos"), F.col("_neg")
    value = (
        F.when((pos > 0) & (neg > 0), F.col("_pairs") / (pos * neg))
        .when(pos > 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    return total.select("model", value.alias("auc_roc"))


def roc_points(
    predictions: DataFrame, label: str = "label", score: str = "score", pieces: int | None = None
) -> DataFrame:
    """Every threshold of every model: rows at or above it by class, and the rates they give.

    One row per distinct score. Counts above a score are what is left of the model's totals
    after running sums of those below, which are split over pieces of the score range as for
    the area; a piece's row carries them on.
    """
    scored = predictions.select(
        "model", F.col(label).cast("int").alias("_y"), F.col(score).cast("double").alias("threshold")
    ).filter("_y IS NOT NULL AND threshold IS NOT NULL")
    counts = materialize(
        scored.groupBy("model", "threshold").agg(
            F.count_if(F.col("_y") == 1).alias("_pos"), F.count_if(F.col("_y") == 0).alias("_neg")
        ),
        "score-counts",
    )
    before = W.partitionBy("model", PIECE).orderBy("threshold").rowsBetween(W.unboundedPreceding, -1)
    inside = with_piece(counts, "threshold", split_points(counts, "threshold", pieces)).withColumns(
        {f"{c}_below": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("_pos", "_neg")}
    )
    whole = W.partitionBy("model")
    per_piece = inside.groupBy("model", PIECE).agg(F.sum("_pos").alias("_pos_in"), F.sum("_neg").alias("_neg_in"))
    # A row for each model and piece.
    carried = per_piece.select(
        "model", PIECE,
        *[running_before(F.col(f"{c}_in"), "model").alias(f"{c}_before") for c in ("_pos", "_neg")],
        *[F.sum(f"{c}_in").over(whole).alias(f"{c}_all") for c in ("_pos", "_neg")],
    )
    tp = F.col("_pos_all") - F.col("_pos_before") - F.col("_pos_below")
    fp = F.col("_neg_all") - F.col("_neg_before") - F.col("_neg_below")
    return inside.join(carried, ["model", PIECE]).select(
        "model", "threshold", tp.alias("tp"), fp.alias("fp"),
        (F.col("_pos_all") - tp).alias("fn"), (F.col("_neg_all") - fp).alias("tn"),
        _ratio(tp, F.col("_pos_all")).alias("true_positive_rate"),
        _ratio(fp, F.col("_neg_all")).alias("false_positive_rate"),
        _ratio(tp, tp + fp).alias("precision"),
    )


def choose_threshold(points: DataFrame, false_positive: float = 1.0, false_negative: float = 1.0) -> DataFrame:
    """The threshold of least cost per model, the highest of several."""
    cost = F.col("fp") * F.lit(float(false_positive)) + F.col("fn") * F.lit(float(false_negative))
    least = F.min(F.struct(cost.alias("cost"), (-F.col("threshold")).alias("_low"), "tp", "fp", "fn", "tn"))
    found = points.groupBy("model").agg(least.alias("_best"))
    return found.select("model", (-F.col("_best._low")).alias("threshold"), *[f"_best.{c}" for c in ("cost", "tp", "fp", "fn", "tn")])


def check_metrics(metrics: DataFrame, expected_rows: int | None = None) -> DataFrame:
    """Which of the three consistency rules each model's figures keep."""
    rates = [c for c in [*RATES, "auc_roc"] if c in metrics.columns]
    total = sum((F.col(c) for c in COUNTS[1:]), F.col(COUNTS[0]))
    rows = F.col("test_rows") if expected_rows is None else F.lit(expected_rows)

    def every(conditions: list[Column]) -> Column:
        kept = F.lit(True)
        for c in conditions:
            kept = kept & F.coalesce(c, F.lit(False))
        return kept

    return metrics.select(
        "model",
        every([F.col(c) >= 0 for c in COUNTS]).alias("counts_ok"),
        every([total == rows]).alias("total_ok"),
        every([~F.isnan(c) & F.col(c).between(0.0, 1.0) for c in rates]).alias("rates_ok"),
    )


def enforce_metrics(metrics: DataFrame, expected_rows: int | None = None) -> None:
    """Raise unless every model keeps every rule; reads one row per model."""
    broken = check_metrics(metrics, expected_rows).filter(
        "NOT (counts_ok AND total_ok AND rates_ok)"
    )
    found = [r["model"] for r in broken.collect()]
    if found:
        raise MetricValidationError(f"inconsistent figures for {found}")


def _looked_up(values: dict[str, float | int], kind: str) -> Column:
    """Value per model from a small mapping, without a join; NULL where it has none."""
    found = F.lit(None)
    for name, value in values.items():
        found = F.when(F.col("model") == name, F.lit(value)).otherwise(found)
    return found.cast(kind)


def comparison_report(
    predictions: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    score: str = "score",
    known: dict[str, dict] | None = None,
    order: Sequence[str] = tuple(MODEL_ORDER),
) -> DataFrame:
    """The 17-column report. ``known`` holds, per model, what predictions cannot
    tell: train rows, feature dimension and the two timings. A model of ``known`` without a
    prediction (the test side is empty) has a row of zeros."""
    known = known or {}
    counted = confusion(predictions, label, prediction)
    if known:
        # A row per model on either side.
        names = predictions.sparkSession.createDataFrame([(m,) for m in known], "model string")
        counted = names.join(counted, "model", "full").fillna(0, [c for c in counted.columns if c != "model"])
    figures = with_rates(counted).join(auc(predictions, label, score), "model", "left")
    figures = figures.withColumn("auc_roc", F.when(F.col("test_rows") == 0, 0.0).otherwise(F.col("auc_roc")))
    rounded = figures.withColumns({c: F.round(c, 6) for c in [*RATES, "auc_roc"]})
    facts = {
        "train_rows": "long",
        "feature_dimension": "long",
        "training_time_seconds": "double",
        "prediction_time_seconds": "double",
    }
    full = rounded.withColumns(
        {
            fact: _looked_up({m: k[fact] for m, k in known.items() if fact in k}, kind)
            for fact, kind in facts.items()
        }
    )
    return in_report_order(full.select(REPORT_COLUMNS), order)


def in_report_order(report: DataFrame, order: Sequence[str] = tuple(MODEL_ORDER)) -> DataFrame:
    """Rows in the given order of models, others after them by name."""
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    return report.orderBy(F.when(place > 0, place).otherwise(len(order) + 1), "model")


SELECTION_METRICS = ["f1", "recall", "auc_roc", "precision", "accuracy"]


def champion(report: DataFrame, metric: str = "f1", at_least: float | None = None) -> DataFrame:
    """The report row with the best metric; then higher AUC, then faster prediction.

    With ``at_least`` a model below it is not chosen, and there may be no row.
    """
    if metric not in SELECTION_METRICS:
        raise ValueError(f"cannot select by {metric!r}; choose one of {SELECTION_METRICS}")
    eligible = report if at_least is None else report.filter(F.col(metric) >= at_least)
    return eligible.orderBy(
        F.desc(metric), F.desc("auc_roc"), F.asc_nulls_last("prediction_time_seconds"), F.asc("model")
    ).limit(1)

