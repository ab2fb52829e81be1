import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from wardlight.errors import MetricValidationError
from wardlight.operators import metrics


def predictions(spark, cells, model="m"):
    rows = [
        (model, y, p, float(p)) for (y, p), n in cells.items() for _ in range(n)
    ]
    return spark.createDataFrame(rows, "model string, label int, prediction int, score double")


def test_confusion(spark):
    row = metrics.confusion(predictions(spark, {(1, 1): 25, (0, 0): 65, (0, 1): 5, (1, 0): 5})).first()
    assert (row["tp"], row["tn"], row["fp"], row["fn"], row["test_rows"]) == (25, 65, 5, 5, 100)


def counted(spark, **counts):
    return spark.createDataFrame(
        [("m", counts.get("test_rows", sum(counts.values())), counts["tp"], counts["tn"], counts["fp"], counts["fn"])],
        "model string, test_rows long, tp long, tn long, fp long, fn long",
    )


def test_rates(spark):
    row = metrics.with_rates(counted(spark, tp=20, tn=70, fp=5, fn=5)).first()
    got = [round(row[c], 6) for c in ("accuracy", "precision", "recall", "specificity", "f1")]
    assert got == [0.9, 0.8, 0.8, round(70 / 75, 6), 0.8]
    zero = metrics.with_rates(counted(spark, tp=0, tn=0, fp=0, fn=0)).first()
    assert all(zero[c] == 0.0 for c in metrics.RATES)


def test_checks(spark):
    figures = metrics.with_rates(counted(spark, tp=10, tn=80, fp=5, fn=5))
    metrics.enforce_metrics(figures, 100)
    with pytest.raises(MetricValidationError):
        metrics.enforce_metrics(figures, 200)
    from pyspark.sql import functions as F

    for wrong in (1.5, float("nan"), float("inf"), None):
        with pytest.raises(MetricValidationError):
            metrics.enforce_metrics(figures.withColumn("auc_roc", F.lit(wrong).cast("double")), 100)
    with pytest.raises(MetricValidationError):
        metrics.enforce_metrics(figures.withColumn("tp", F.lit(-1)), 89)


def pairs_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_auc_equals_pair_counting(spark, hot):
    rng = random.Random(7)
    rows, expected = [], {}
    for model in ("a", "b", "c"):
        own = [
            (int(rng.random() < 0.3), 0.5 if rng.random() < hot else round(rng.random(), 2 if model == "c" else 9))
            for _ in range(600)
        ]
        expected[model] = pairs_auc(own)
        rows += [(model, y, s) for y, s in own]
    df = spark.createDataFrame(rows, "model string, label int, score double").repartition(5)
    for pieces in (1, 2, 7, 50):
        got = {r["model"]: r["auc_roc"] for r in metrics.auc(df, pieces=pieces).collect()}
        assert got == pytest.approx(expected, abs=1e-12)
    one = df.filter("model = 'a'").withColumn("label", df.label.cast("double"))
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label")
    assert evaluator.evaluate(one) == pytest.approx(expected["a"], abs=1e-3)


def test_auc_of_one_class(spark):
    df = spark.createDataFrame(
        [("up", 1, 0.3), ("up", 1, 0.9), ("down", 0, 0.3)], "model string, label int, score double"
    )
    assert {r["model"]: r["auc_roc"] for r in metrics.auc(df).collect()} == {"up": 1.0, "down": 0.0}


def test_auc_of_nothing(spark):
    assert metrics.auc(spark.createDataFrame([], "model string, label int, score double")).count() == 0


def test_report_columns_and_order(spark):
    df = predictions(spark, {(1, 1): 2, (0, 0): 3, (0, 1): 1}, "gbt").unionByName(
        predictions(spark, {(1, 0): 2, (0, 0): 3}, "random_forest")
    )
    report = metrics.comparison_report(df, known={"gbt": {"train_rows": 7, "training_time_seconds": 1.25}})
    assert report.columns == metrics.REPORT_COLUMNS and len(report.columns) == 17
    first, second = report.collect()
    assert (first["model"], second["model"]) == ("random_forest", "gbt")
    assert second["train_rows"] == 7 and first["train_rows"] is None


def test_a_model_without_predictions_has_a_row_of_zeros(spark):
    some = predictions(spark, {(1, 1): 2, (0, 0): 3}, "gbt")
    for given in (some, some.limit(0)):
        report = metrics.comparison_report(given, known={"gbt": {"train_rows": 7}, "random_forest": {"train_rows": 8}})
        row = report.filter("model = 'random_forest'").first()
        assert row["train_rows"] == 8
        assert all(row[c] == 0 for c in [*metrics.COUNTS, *metrics.RATES, "test_rows", "auc_roc"])
        assert [r["model"] for r in report.collect()] == ["random_forest", "gbt"]
        metrics.enforce_metrics(report)
    assert metrics.comparison_report(some).count() == 1


def test_champion(spark):
    rows = [("a", 0.6, 0.7, 0.5, 2.0), ("b", 0.6, 0.8, 0.4, 3.0), ("c", 0.6, 0.8, 0.9, 1.0), ("d", 0.5, 0.9, 0.1, 0.1)]
    report = spark.createDataFrame(
        rows, "model string, f1 double, auc_roc double, recall double, prediction_time_seconds double"
    )
    assert metrics.champion(report).first()["model"] == "c"
    assert metrics.champion(report, "auc_roc").first()["model"] == "d"
    assert metrics.champion(report, "recall").first()["model"] == "c"
    assert metrics.champion(report, "f1", at_least=0.7).first() is None
    with pytest.raises(ValueError):
        metrics.champion(report, "speed")


def test_area_under_the_points_is_the_auc(spark):
    """Ties, one class only and a hot score; the trapezoids of the points give the exact area."""
    rows = [("a", i % 3 == 0, float(i * 7 % 20)) for i in range(200)] + [("a", i % 2, 5.0) for i in range(100)]
    rows += [("b", 1, 0.5), ("b", 1, 0.7), ("a", None, 1.0), ("a", 1, None)]
    frame = spark.createDataFrame([(m, None if y is None else int(y), s) for m, y, s in rows], "model string, label int, score double")
    points = metrics.roc_points(frame, pieces=4).collect()
    area, at = 0.0, (0.0, 0.0)
    for r in sorted((r for r in points if r["model"] == "a"), key=lambda r: -r["threshold"]):
        here = (r["false_positive_rate"], r["true_positive_rate"])
        area, at = area + (here[0] - at[0]) * (here[1] + at[1]) / 2, here
    assert at == (1.0, 1.0)
    exact = {r["model"]: r["auc_roc"] for r in metrics.auc(frame, pieces=4).collect()}
    assert area == pytest.approx(exact["a"], abs=1e-12)
    best = metrics.choose_threshold(metrics.roc_points(frame)).collect()
    least = min(r["fp"] + r["fn"] for r in points if r["model"] == "a")
    assert {r["model"]: r["cost"] for r in best} == {"a": least, "b": 0.0}
    assert metrics.roc_points(frame.limit(0)).count() == 0
