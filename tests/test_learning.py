import itertools
import math
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from wardlight import schema as S
from wardlight.errors import FeatureValidationError, SchemaValidationError
from wardlight.learning import artifacts, categories, evaluate, importance, models
from wardlight.learning import features as fv
from wardlight.learning import tree_contributions as tree_shapley
from wardlight.operators import scoring, views
from wardlight.plans import jobs
from wardlight.session import materialize, scratch_path


@pytest.fixture(scope="module")
def vectors(clean):
    from wardlight.plans.jobs import prepare_training

    return prepare_training(clean)


@pytest.fixture(scope="module")
def embedded(spark, tiny):
    data = spark.read.parquet(f"{tiny}/embeddings.parquet").select(
        F.col("vec_id").alias("encounter_id"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        F.when(F.col("label") < 3, 1).otherwise(0).alias("readmission_target"),
    )
    return fv.split_data(materialize(data, "embedded"))


@pytest.fixture(scope="module")
def trained(spark, embedded):
    folder = scratch_path(spark, "models")
    found, records = models.train_all_models(*embedded, folder)
    return folder, found, records


def test_synthetic_rows(spark):
    rows = [
        tuple(["val_a"] * 41 + [1.0] * 26 + [1, 1001, 2002]) for _ in range(2)
    ]
    kinds = (
        [f"{c} string" for c in S.CATEGORICAL_FEATURES]
        + [f"{c} double" for c in S.NUMERICAL_FEATURES]
        + ["readmission_target int", "encounter_id long", "patient_nbr long"]
    )
    df = spark.createDataFrame(rows, ", ".join(kinds))
    model = fv.fit_features(df)
    out = fv.transform_features(df, model)
    assert out.columns == ["encounter_id", "patient_nbr", "features", "readmission_target"]
    row = out.first()
    assert row["features"].size == 41 * 3 + 26 and row["encounter_id"] == 1001
    bare = fv.transform_features(df, model, include_identifiers=False)
    assert bare.columns == ["features", "readmission_target"]


def test_vectors_are_whole_and_finite(vectors, clean):
    train, test, model = vectors
    assert train.count() + test.count() == clean.count()
    size = sum(len(labels) + 2 for labels in model.stages[1].labelsArray) + 26
    slots = fv.vector_slots(model)
    assert len(slots) == size and len({s for s in slots}) == size
    both = train.unionByName(test).select(vector_to_array("features").alias("v"))
    bad = both.filter(F.exists("v", lambda x: F.isnan(x) | x.isNull())).count()
    assert bad == 0 and {r[0] for r in both.select(F.size("v")).distinct().collect()} == {size}


def test_pipeline_has_one_indexer(clean):
    stages = fv.build_feature_pipeline().getStages()
    assert len(stages) == 5 and len(stages[1].getInputCols()) == 41


def test_unseen_and_missing_categories_share_a_slot(spark):
    seen = spark.createDataFrame([("b",), ("a",), ("a",), ("c",), (None,)], "race string")
    model = fv.string_indexer(["race"]).fit(seen)
    assert list(model.labelsArray[0]) == ["a", "b", "c"]
    new = spark.createDataFrame([("a",), ("zz",), (None,)], "race string")
    assert [r["race_indexed"] for r in model.transform(new).collect()] == [0.0, 3.0, 3.0]


def test_one_unknown_number_spoils_nothing(spark, features):
    model = fv.build_feature_pipeline().fit(features)
    unknown = features.limit(1).withColumn("age_midpoint", F.lit(None).cast("int"))
    out = fv.transform_features(unknown, model).first()
    assert all(math.isfinite(x) for x in out["features"].toArray())


def test_feature_model_reloads(spark, features):
    model = fv.fit_features(features)
    path = scratch_path(spark, "feature-model")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    a, b = (fv.transform_features(features, m) for m in (model, again))
    joined = a.join(b.select("encounter_id", F.col("features").alias("other")), "encounter_id")
    assert joined.filter(vector_to_array("features") != vector_to_array("other")).count() == 0
    assert fv.feature_dimension(a) == a.first()["features"].size


def test_missing_feature_column_is_refused(features):
    with pytest.raises(FeatureValidationError):
        fv.fit_features(features.drop("race"))


def test_split_does_not_move(features):
    sides = []
    for parts in (1, 7):
        train, test = fv.split_data(features.repartition(parts))
        sides.append({r[0] for r in train.select("encounter_id").collect()})
        assert train.count() + test.count() == features.count()
    assert sides[0] == sides[1] and 0.75 < len(sides[0]) / features.count() < 0.85


def test_split_keeps_rows_without_a_key_and_reads_few_columns(spark, features, plan):
    keyless = features.withColumn("encounter_id", F.lit(None).cast("long"))
    train, test = fv.split_data(keyless, 0.61803, 0.38197)
    assert train.count() + test.count() == features.count() and train.count() and test.count()
    path = scratch_path(spark, "split")
    features.write.parquet(path)
    side, _ = fv.split_data(spark.read.parquet(path))
    read = plan(side.select("encounter_id")).split("ReadSchema: ")[1].split("\n")[0]
    assert read == "struct<encounter_id:bigint,patient_nbr:bigint>"


def test_split_arguments(features):
    split = fv.split_data
    for ratios in ((1.5, 0.2), (0.8, 0.0), (0.5, 0.2)):
        with pytest.raises(ValueError):
            split(features, *ratios)
    with pytest.raises(ValueError, match="readmission_target"):
        split(features.drop("readmission_target"))


def test_settings():
    assert list(models.all_model_settings()) == ["logistic_regression", "random_forest", "decision_tree", "gbt"]
    assert models.build_estimator("gbt").getMaxIter() == 30
    assert models.build_estimator("random_forest", numTrees=3).getNumTrees() == 3
    with pytest.raises(KeyError):
        models.model_settings("svm")
    for call in (models.build_estimator, lambda n: models.load_model(n, "/nowhere")):
        with pytest.raises(ValueError):
            call("svm")


def test_models_carry_no_summary(trained):
    assert not any(getattr(model, "hasSummary", False) for model in trained[1].values())


def test_training_records(trained, embedded):
    folder, found, records = trained
    train, test = embedded
    assert list(found) == list(models.SETTINGS)
    for name, record in records.items():
        assert record["train_rows"] == train.count() and record["test_rows"] == test.count()
        assert record["feature_dimension"] == 64 and record["path"] == f"{folder}/{name}"
    assert not train.is_cached


def test_report_of_trained_models(trained, embedded):
    _, found, records = trained
    path = scratch_path(embedded[1].sparkSession, "report")
    report = evaluate.evaluate_models(found, embedded[1], records, csv=path)
    rows = report.collect()
    assert [r["model"] for r in rows] == list(models.SETTINGS)
    lines = [r[0] for r in embedded[1].sparkSession.read.text(path).collect()]
    assert len(lines) == 5 and lines[0] == ",".join(report.columns)
    assert [line.split(",")[0] for line in lines[1:]] == list(models.SETTINGS)
    for r in rows:
        assert r["tp"] + r["tn"] + r["fp"] + r["fn"] == r["test_rows"] == embedded[1].count()
        assert r["prediction_time_seconds"] > 0 and 0 <= r["auc_roc"] <= 1


def test_stored_models_give_the_same_report(trained, embedded):
    folder, found, _ = trained
    kept = ["model", "tp", "tn", "fp", "fn", "auc_roc"]
    a = evaluate.evaluate_models(found, embedded[1]).select(kept)
    b = evaluate.evaluate_models(folder, embedded[1]).select(kept)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    with pytest.raises(TypeError):
        evaluate.evaluate_models([1], embedded[1])


def test_auc_of_a_model_agrees_with_spark(trained, embedded):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    _, found, _ = trained
    for name, model in found.items():
        row = evaluate.evaluate_model(model, embedded[1], name).first()
        own = BinaryClassificationEvaluator(labelCol="readmission_target").evaluate(
            model.transform(embedded[1])
        )
        assert row["auc_roc"] == pytest.approx(own, abs=1e-5)


def test_champion_is_stored_with_its_description(spark, trained, embedded):
    folder, found, records = trained
    report = evaluate.evaluate_models(found, embedded[1], records)
    stored = evaluate.store_champion(found, report, folder, "auc_roc", models.all_model_settings(), "sig")
    model, metadata = evaluate.load_champion(spark, folder)
    row = metadata.first()
    assert row == stored.first() and row["selected_by"] == "auc_roc" and row["signature"] == "sig"
    assert row["auc_roc"] == max(r["auc_roc"] for r in report.collect())
    a, b = evaluate.predict(model, embedded[1]), evaluate.predict(found[row["model"]], embedded[1])
    assert a.exceptAll(b).count() == 0


def test_cross_validation(embedded):
    fitted, table = models.cross_validate(
        embedded[0], "logistic_regression", {"regParam": [0.01, 10.0]}, folds=3, maxIter=10
    )
    rows = table.collect()
    assert len(rows) == 2 and all(0 <= r["mean_metric"] <= 1 for r in rows)
    assert max(r["mean_metric"] for r in rows) == max(fitted.avgMetrics)


def test_importance_and_factors(spark, vectors):
    train, test, fitted = vectors
    model, _ = models.train_model("logistic_regression", train, maxIter=15)
    slots = fv.vector_slots(fitted)
    table = importance.feature_importance(spark, {"logistic_regression": model}, slots)
    rows = table.orderBy("place").collect()
    assert {r["feature"] for r in rows} == set(S.FEATURE_COLUMNS)
    total = sum(abs(x) for x in model.coefficients.toArray())
    assert sum(r["importance"] for r in rows) == pytest.approx(total)
    parts = scoring.model_contribution_array(model, slots)
    sums = scoring.contributions(test, parts).groupBy("encounter_id").agg(F.sum("contribution").alias("s"))
    margins = model.transform(test).select(
        "encounter_id", (vector_to_array("rawPrediction")[1] - model.intercept).alias("m")
    )
    assert sums.join(margins, "encounter_id").filter("abs(s - m) > 1e-9").count() == 0
    top = scoring.top_factors(test, parts, 3)
    long = scoring.top_factors_long(scoring.contributions(test, parts), 3)
    assert top.exceptAll(long).count() == 0 and top.count() == 3 * test.count()


def test_scoring_with_a_model(vectors):
    train, test, _ = vectors
    model, _ = models.train_model("decision_tree", train)
    scored = scoring.score_with_model(test, model)
    assert scored.count() == test.count()
    assert scored.filter("risk_score < 0 OR risk_score > 1 OR risk_tier IS NULL").count() == 0


def test_shuffling_moves_every_value_once(spark, features):
    moved = importance.with_shuffled(features, "time_in_hospital")
    assert moved.columns == features.columns
    rest = [c for c in features.columns if c != "time_in_hospital"]
    assert moved.select(rest).exceptAll(features.select(rest)).count() == 0
    counts = [
        dict(map(tuple, f.groupBy("time_in_hospital").count().collect())) for f in (moved, features)
    ]
    # A chain, not a cycle: the first row keeps its value and the last one's is dropped.
    assert sum(abs(counts[0].get(k, 0) - counts[1].get(k, 0)) for k in counts[0] | counts[1]) <= 2
    pairs = moved.select("encounter_id", F.col("time_in_hospital").alias("t")).join(features, "encounter_id")
    assert pairs.filter("t <> time_in_hospital").count() > 0.8 * features.count()


def test_permutation_importance_finds_the_column_that_matters(spark, features):
    told = materialize(
        features.withColumn("readmission_target", (F.col("time_in_hospital") > 7).cast("int")), "told"
    )
    fitted = fv.fit_features(told)
    model, _ = models.train_model("decision_tree", fv.transform_features(told, fitted), maxDepth=2)
    rows = importance.permutation_importance(
        fitted, model, told, ["num_procedures", "time_in_hospital"]
    ).collect()
    drops = {r["feature"]: r["auc_drop"] for r in rows}
    assert drops["time_in_hospital"] > 0.3 and abs(drops["num_procedures"]) < 1e-9
    assert {r["feature"]: r["place"] for r in rows}["time_in_hospital"] == 1


def test_category_tables_agree_with_the_indexer(spark, features):
    columns = ["race", "age_category", "payer_code", "diag_1", "number_inpatient"]
    columns = [c for c in columns if c in features.columns]
    some = features.withColumn("empty", F.lit(None).cast("string"))
    table = categories.fit_categories(some, [*columns, "empty"])
    usual = fv.string_indexer(columns).fit(features)
    unseen = some.limit(3).withColumn("race", F.lit("never seen"))
    for rows in (some, unseen):
        a = categories.index_categories(rows, table).select("encounter_id", *[f"{c}_indexed" for c in columns])
        b = usual.transform(rows).select("encounter_id", *[f"{c}_indexed" for c in columns])
        assert a.exceptAll(b).count() == 0 and a.count() == rows.count()
    assert {r[0] for r in categories.index_categories(some, table).select("empty_indexed").collect()} == {0.0}
    path = scratch_path(spark, "categories")
    table.save(path)
    assert categories.load_categories(spark, path, [*columns, "empty"]).sizes == table.sizes
    encoded = fv.one_hot_encoder(columns).fit(usual.transform(features))
    wanted = [*[f"{c}_vec" for c in columns], "num_medications"]
    usual_vectors = fv.vector_assembler(wanted, "v").transform(encoded.transform(usual.transform(features)))
    own = categories.category_vectors(features, categories.fit_categories(features, columns), ["num_medications"], "v")
    both = own.select("encounter_id", "v").join(usual_vectors.select("encounter_id", F.col("v").alias("u")), "encounter_id")
    assert both.filter(vector_to_array("v") != vector_to_array("u")).count() == 0 and both.count() == features.count()


def test_very_many_categories(spark):
    """200,000 values, a third of the rows with one of them; no label reaches the driver."""
    rows = spark.range(300_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('v', id) END AS code")
    table = categories.fit_categories(rows, ["code"])
    assert table.sizes == {"code": 200_001}
    found = categories.category_vectors(rows, table)
    assert found.schema["features"].metadata["ml_attr"]["num_attrs"] == 200_003
    indexed = categories.index_categories(rows, table)
    sums = indexed.agg(F.count_distinct("code_indexed"), F.max("code_indexed"), F.count_if(F.col("code_indexed") == 0)).first()
    assert tuple(sums) == (200_001, 200_000.0, 100_000)


@pytest.mark.parametrize("name,output", [("decision_tree", "probability"), ("random_forest", "probability"), ("gbt", "rawPrediction")])
def test_tree_contributions_make_up_the_output(embedded, trained, name, output):
    train, test = embedded
    model = trained[1][name]
    parts, base = tree_shapley.tree_contributions(test, model)
    total = F.aggregate("contributions", F.lit(base), lambda a, p: a + p["contribution"])
    own = model.transform(test).select("encounter_id", vector_to_array(output)[1].alias("own"))
    both = parts.select("encounter_id", total.alias("total")).join(own, "encounter_id")
    assert both.count() == test.count() and both.filter("abs(total - own) > 1e-9").count() == 0


def test_tree_contributions_against_all_subsets(spark):
    """Eight features, categorical splits too: Shapley values by their definition."""
    rng = random.Random(1)
    rows = [(i, *[float(rng.randrange(4)) for _ in range(8)]) for i in range(400)]
    frame = spark.createDataFrame(rows, "encounter_id long, " + ", ".join(f"x{k} double" for k in range(8)))
    frame = frame.withColumn("x7", F.col("x7").alias("x7", metadata={"ml_attr": {"type": "nominal", "num_vals": 4}}))
    data = fv.vector_assembler([f"x{k}" for k in range(8)], "features").transform(
        frame.withColumn("readmission_target", ((F.col("x0") * F.col("x1") + F.col("x7") % 3) > 3).cast("int"))
    )
    model, _ = models.train_model("decision_tree", data, maxDepth=5)
    parts, base = tree_shapley.tree_contributions(data, model)
    leaves, _ = tree_shapley.flatten(spark, model)
    used = sorted({f for leaf in leaves for f in leaf.features})
    assert 7 in used

    def value(row, known):
        total = 0.0
        for leaf in leaves:
            part = leaf.value
            for f, share, conditions in zip(leaf.features, leaf.shares, leaf.conditions, strict=True):
                if f in known:
                    for test, left in conditions:
                        inside = row[f] in test if isinstance(test, frozenset) else row[f] <= test
                        part *= inside == left
                else:
                    part *= share
            total += part
        return total

    for r in parts.orderBy("encounter_id").limit(12).collect():
        row, n = rows[r["encounter_id"]][1:], len(used)
        got = {p["feature"]: p["contribution"] for p in r["contributions"]}
        for f in used:
            rest = [g for g in used if g != f]
            expected = sum(
                math.factorial(k) * math.factorial(n - k - 1) / math.factorial(n) * (value(row, {*s, f}) - value(row, set(s)))
                for k in range(n) for s in itertools.combinations(rest, k)
            )
            assert got.get(f"slot {f}", 0.0) == pytest.approx(expected, abs=1e-12)


def test_scoring_from_an_artifact_in_a_fresh_session(spark, clean, tiny, tmp_path):
    """Trained, published and promoted; a new session scores raw CSV; a day runs twice."""
    from wardlight.sources import files
    from wardlight.sources.encounters import read_encounters

    source, folder, scores, stored = (str(tmp_path / x) for x in ("raw", "artifacts", "scores", "clean"))
    files.write_csv(S.raw_header_columns(read_encounters(spark, tiny)), source)
    files.write_parquet(clean, stored)
    train, test, fitted = jobs.prepare_training(clean)
    signature = artifacts.signature_of(views.patient_features(clean), jobs.MODEL_INPUTS)
    versions = []
    for depth in (2, 3):
        model, _ = models.train_model("decision_tree", train, maxDepth=depth)
        versions.append(artifacts.publish(spark, folder, artifacts.combine(fitted, model), signature, {"depth": depth}))
    assert versions == [1, 2] and artifacts.champion_version(spark, folder) is None
    artifacts.promote(spark, folder, 2, None)
    for version, expected, error in ((1, None, artifacts.PromotionConflict), (9, 2, ValueError)):
        with pytest.raises(error):
            artifacts.promote(spark, folder, version, expected)
    fresh = spark.newSession()
    first = jobs.run_scoring(fresh, source, folder, scores, "2024-01-01")
    rows = sorted(map(tuple, first.collect()), key=repr)
    assert len(rows) == clean.count() and {r[-2] for r in rows} == {2}
    jobs.run_scoring(fresh, source, folder, scores, "2024-01-02", version=1)
    again = jobs.run_scoring(fresh, source, folder, scores, "2024-01-01")
    assert sorted(map(tuple, again.collect()), key=repr) == rows
    assert spark.read.parquet(scores).count() == 2 * len(rows)
    own = scoring.score_with_model(test, artifacts.load_version(spark, folder)[1].stages[-1])
    both = own.join(again.select("encounter_id", F.col("risk_score").alias("stored")), "encounter_id")
    assert both.count() == test.count() and both.filter("abs(risk_score - stored) > 1e-12").count() == 0
    with pytest.raises(SchemaValidationError):
        artifacts.check_signature(clean.drop("age"), signature)


def test_only_one_writer_takes_an_entry(spark, tmp_path):
    """Two writers that saw the same log: the second looks again and takes the next number."""
    folder = str(tmp_path / "log")
    seen_by_first = []

    def slow(seen):
        if not seen_by_first:
            artifacts._append(spark, folder, lambda s: {"kind": "publish", "version": 7, "path": "other"})
        seen_by_first.append(len(seen))
        return {"kind": "publish", "version": len(seen) + 1, "path": "own"}

    assert artifacts._append(spark, folder, slow)["entry"] == 2 and seen_by_first == [0, 1]
    assert [r["path"] for r in artifacts.log_entries(spark, folder).collect()] == ["other", "own"]


def test_a_complete_comparison_refuses_missing_models(spark):
    with pytest.raises(ValueError, match="gbt"):
        evaluate.evaluate_models({}, spark.range(1), names=["gbt"], complete=True)


def test_fits_get_rows_dealt_by_their_number(spark, monkeypatch):
    """One stored file of sparse vectors is one task by its size, and all its rows in memory at once."""
    from wardlight.learning import models

    seen = []

    class Watched:
        numFeatures = 1

        def fit(self, rows):
            seen.append([r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()])
            return self

    monkeypatch.setattr(models, "build_estimator", lambda name, **changed: Watched())
    rows = materialize(spark.range(60_000).coalesce(1), "rows")
    models.train_model("gbt", rows)
    models.train_all_models(rows, names=["gbt"])
    assert [len(s) for s in seen] == [3, 3] and max(max(s) for s in seen) <= 25_000
    assert sum(seen[0]) == sum(seen[1]) == 60_000 and not rows.is_cached


@pytest.mark.parametrize("alone", [10**6, 100])
def test_packed_boosting_is_sparks(spark, monkeypatch, alone):
    """The same trees as Spark's own fit, from one task and from several that add up their sums; the
    rows have blocks of one-hot slots, numbers with and without zeros, and a slot that never changes."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.linalg import Vectors

    from wardlight.learning import boosting

    monkeypatch.setattr(boosting, "ALONE_ROWS", alone)
    monkeypatch.setattr(boosting, "TASK_ROWS", 200)
    draw, rows = random.Random(5), []
    for i in range(900):
        kind, number, other = draw.randrange(6), draw.randrange(40), draw.choice([0.0, 0.0, 0.0, 2.5, -1.0])
        label = float(draw.random() < (0.2 + 0.5 * (kind == 2) + 0.2 * (number > 25) - 0.1 * (other < 0)))
        slots = {kind: 1.0, 6: 3.0, 7: float(number + 1), 8: other}
        vector = Vectors.sparse(9, {k: v for k, v in slots.items() if v})
        rows.append((i, vector if i % 3 else Vectors.dense(vector.toArray()), label))
    data = spark.createDataFrame(rows, ["encounter_id", "features", "readmission_target"]).repartition(4).cache()
    settings = {"featuresCol": "features", "labelCol": "readmission_target", "maxIter": 3, "maxDepth": 3, "seed": 1}
    own, packed = GBTClassifier(**settings).fit(data), boosting.PackedGBT(**settings).fit(data)
    assert own.treeWeights == packed.treeWeights and own.numFeatures == packed.numFeatures == 9

    def shape(model):
        lines = model.toDebugString.split("\n")[1:]
        return [x if "Predict" not in x else round(float(x.split()[-1]), 9) for x in lines]

    assert shape(own) == shape(packed)
    assert list(own.featureImportances.toArray()) == pytest.approx(list(packed.featureImportances.toArray()))
    both = own.transform(data).select("encounter_id", vector_to_array("probability")[1].alias("own")).join(
        packed.transform(data).select("encounter_id", vector_to_array("probability")[1].alias("packed")), "encounter_id"
    )
    assert both.filter(F.abs(F.col("own") - F.col("packed")) > 1e-9).count() == 0
    data.unpersist()


def test_boosting_keeps_rows_packed(vectors):
    """A row of the feature table costs a few dozen entries of two bytes, not four bytes for each slot."""
    from wardlight.learning import boosting

    train, _, _ = vectors
    assert isinstance(models.build_estimator("gbt"), boosting.PackedGBT)
    rows = models.build_estimator("gbt")._rows(train)
    bins = boosting.find_bins(rows, train.count(), 32, 42)
    whole = rows.select("v").toArrow().column("v").combine_chunks()
    entries, starts = boosting.pack(whole, bins)
    assert starts[-1] == len(entries) and len(starts) == bins.codes + 1
    assert entries.nbytes < 120 * len(whole) < 4 * bins.size * len(whole)


@pytest.mark.parametrize("label", [2.0, None])
def test_boosting_refuses_other_labels(spark, label):
    from pyspark.ml.linalg import Vectors

    rows = [(Vectors.dense([float(i)]), float(i % 2)) for i in range(8)] + [(Vectors.dense([1.0]), label)]
    data = spark.createDataFrame(rows, ["features", "readmission_target"])
    with pytest.raises(Exception, match="Labels MUST"):
        models.build_estimator("gbt", maxIter=1).fit(data)
