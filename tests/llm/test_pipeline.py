"""The pipeline's stages against what each is to keep."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from wardlight.session import materialize

COLUMNS = list(pipeline.COLUMNS)


@pytest.fixture(scope="module")
def stages(spark, tiny):
    docs, out = spark.read.parquet(f"{tiny}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in pipeline.STAGES:
        docs = materialize(stage(spark, docs, tiny), name)
        out[name] = docs
    return out


def test_stages_and_columns(stages):
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["quality_rules", "quality_classifier", "jaccard_join", "unit_dedup", "packing"]
    for name in names[:-1]:
        assert stages[name].columns == COLUMNS
    sizes = [stages[n].count() for n in ["documents", *names[:-1]]]
    assert sizes == sorted(sizes, reverse=True) and sizes[3] < sizes[2] < sizes[0]


def test_clean_documents_stay(spark, stages, tiny):
    clean = spark.read.parquet(f"{tiny}/labels.parquet").filter("quality = 1").select("doc_id")
    for before, after in (("documents", "quality_rules"), ("quality_rules", "quality_classifier")):
        had = stages[before].join(clean, "doc_id", "left_semi").count()
        assert stages[after].join(clean, "doc_id", "left_semi").count() >= 0.99 * had


def test_exact_copies_go(stages):
    texts = stages["jaccard_join"].groupBy("text").count().filter("count > 1")
    assert texts.count() == 0


def test_units_are_cut_and_counted(stages):
    rows = stages["unit_dedup"].filter(F.length("text") != F.col("n_chars")).count()
    assert rows == 0
    assert stages["unit_dedup"].agg(F.sum("n_chars")).first()[0] < stages["jaccard_join"].agg(F.sum("n_chars")).first()[0]


def test_run_packs_what_is_left(spark, stages, tiny):
    packed = pipeline.run(spark, tiny)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == {
        r[0] for r in stages["unit_dedup"].select("doc_id").collect()
    }


def test_empty_documents(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").limit(0)
    for name, stage in pipeline.STAGES:
        docs = materialize(stage(spark, docs, tiny), name)
    assert docs.count() == 0


def test_awkward_documents(spark, tiny):
    """Nulls, empty texts, copies, repeated ids and a clashing column pass through every stage."""
    clean = spark.read.parquet(f"{tiny}/labels.parquet").filter("quality = 1").select("doc_id")
    some = spark.read.parquet(f"{tiny}/documents.parquet").join(clean, "doc_id", "left_semi").orderBy("doc_id").limit(30)
    text = some.first()["text"]
    odd = [(None, text + " And one more ending.", None, None, None), (901, None, "en", "s", 0), (902, "", "en", "s", 0),
           (903, " \n\t", "en", "s", 3), (904, text, "en", "s", 1), (904, text, "en", "s", 1), (905, "Short one.", None, "s", 5)]
    docs = some.unionByName(spark.createDataFrame(odd, some.schema)).withColumn("quality", F.lit("clash"))
    left = {}
    for name, stage in pipeline.STAGES:
        docs = materialize(stage(spark, docs, tiny), name)
        left[name] = docs
    assert not left["quality_rules"].filter("doc_id IN (901, 902, 903)").count()
    assert left["jaccard_join"].filter(F.col("text") == text).count() == 1
    assert not left["unit_dedup"].filter("trim(text) = ''").count()
    assert docs.select("doc_id").distinct().count() == left["unit_dedup"].select("doc_id").distinct().count()
