"""The corpus pipeline: from raw documents to packed training sequences.

Each stage is a function of (spark, docs, sf_dir). All but the last return the columns of
``documents``, and each works on what the one before has kept, written as Parquet and
read again. So what a stage has stored on its way is done with when the next one begins, and
that one drops it: the disk holds the steps of one stage at a time.
"""

from __future__ import annotations

import functools
import threading
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.llm import boosted_trees, jaccard_join, packing, quality_rules, unit_dedup
from wardlight.llm.common import BLANKS, materialize, table
from wardlight.llm.queries import quality_trees
from wardlight.session import drop_scratch, scratch_paths

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_steps = threading.local()


def begins(stage: Stage) -> Stage:
    """The first stage: its steps are noted for the next one."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        before = len(scratch_paths())
        out = stage(spark, docs, sf_dir)
        _steps.paths = scratch_paths()[before:]
        return out

    return run_stage


def follows(stage: Stage) -> Stage:
    """A later stage. Its ``docs`` are stored, so the steps of the stage before are dropped."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_scratch(spark, getattr(_steps, "paths", []))
        return begins(stage)(spark, docs, sf_dir)

    return run_stage


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule go. Short ones and those with some repeats stay: they may be clean."""
    return quality_rules.passing(docs.select(*COLUMNS), min_words=1, max_repeat_percent=90)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.3 go. The trees learn from the labelled documents still here."""
    trees = quality_trees(docs, table(spark, sf_dir, "labels"))
    return boosted_trees.score(docs, trees, *COLUMNS).filter("score >= 0.3").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, the one with the smallest id stays."""
    return jaccard_join.first_of_each(docs.select(*COLUMNS), n=5, percent=80)


def repeated_units(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences, lines and passages that an earlier document has are cut out; the count of characters
    follows. Documents of which nothing is left go."""
    left = unit_dedup.dedup_units(docs, ranks=("doc_id",), unit="passage", keep=("lang", "source"))
    left = left.filter(F.btrim("text", F.lit(BLANKS)) != "")
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of 4096; the rows are the pieces of documents in them."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, length=4096)


STAGES = [
    ("quality_rules", begins(rules)),
    ("quality_classifier", follows(classifier)),
    ("jaccard_join", follows(near_duplicates)),
    ("unit_dedup", follows(repeated_units)),
    ("packing", follows(pack)),
]

#: A trained classifier cannot be written in SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
