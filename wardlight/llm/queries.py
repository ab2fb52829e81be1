"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.llm import (
    boosted_trees,
    byte_bpe,
    jaccard_join,
    packing,
    phrase_index,
    pitman_yor,
    prefix_trie,
    quality_rules,
    structure_repair,
    suffix_dedup,
    unit_dedup,
    url_filter,
    vantage,
)
from wardlight.llm.common import table


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id",
        *[f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "quality.base_failed",
        "quality.kept",
        F.array_join("quality.failed", ",").alias("failed_rules"),
    )


URL_RULES = [
    url_filter.Rule("allow", "org/"),
    url_filter.Rule("block", "example.org/es/"),
    url_filter.Rule("block", "example.org/en/1"),
    url_filter.Rule("allow", "com/fr/"),
    url_filter.Rule("block", "com/de/"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that hosts are made of are counted in the pages' own text."""
    pages = table(spark, sf_dir, "pages")
    judged = url_filter.judge(pages, URL_RULES, url_filter.word_counts(pages, "html"))
    return judged.withColumn("words", F.array_join("words", " "))


def op2_vantage_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factor one: exact search."""
    vectors = table(spark, sf_dir, "embeddings")
    queries = vectors.filter(F.col("vec_id") % 20 == 0)
    return vantage.search(vectors, queries, k=20, metric="inner", factor=1.0)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, length=4096)


def remainder(column: str, by: int):
    """crc32 of the id as text, modulo ``by``."""
    return F.crc32(F.col(column).cast("string")) % by


def quality_trees(docs: DataFrame, labels: DataFrame) -> boosted_trees.Trees:
    """Trained on labels.quality of the rows that are not held out, 20,000 of them at most."""
    seen = labels.select("doc_id", F.col("quality").alias("label")).filter(remainder("doc_id", 5) != 0)
    return boosted_trees.train(docs, seen)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = quality_trees(docs, table(spark, sf_dir, "labels"))
    return boosted_trees.score(docs, trees, "doc_id").select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op7_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf_dir, "documents"), by=7, remainder=2)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = jaccard_join.link(table(spark, sf_dir, "documents"), n=3, percent=90)
    return linked.select("doc_id", "n_shingles", "component_id")


def op9_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = unit_dedup.dedup_units(table(spark, sf_dir, "documents"))
    spans = F.transform(
        F.arrays_zip("removed_starts", "removed_ends"),
        lambda s: F.concat_ws("-", s["removed_starts"], s["removed_ends"]),
    )
    return left.select(
        "doc_id",
        "n_units",
        "n_removed",
        F.array_join(spans, ",").alias("removed_spans"),
        F.length("text").cast("long").alias("n_kept_chars"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=200)
    removed = F.aggregate(
        F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y
    )
    return left.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, finish="digest")


def op11_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = phrase_index.build(docs)
    matches = phrase_index.search(index, table(spark, sf_dir, "benchmark"), window=10)
    return phrase_index.contamination(index, matches).select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie.trie(table(spark, sf_dir, "conversations"), borrow=9, share=5)
    return nodes.drop("ka", "kb")


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return structure_repair.repair(structure_repair.damage(rows))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_vantage_search": op2_vantage_search,
    "op3_packing": op3_packing,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_pitman_yor": op7_pitman_yor,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_unit_dedup": op9_unit_dedup,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_phrase_index": op11_phrase_index,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_structure_repair": op13_structure_repair,
}

#: Units, their normal forms and first occurrences; neighbouring removed units are one span.
OP9_SQL = r"""
WITH units AS (
  SELECT doc_id, unnest(u) AS unit, generate_subscripts(u, 1) AS place
  FROM (SELECT doc_id, regexp_extract_all(text, '[^.!?\n]+[.!?\n]*|[.!?\n]+') AS u FROM documents)
), normal AS (
  SELECT *, trim(regexp_replace(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+', ' ', 'g')) AS form
  FROM units
), flags AS (
  SELECT *, CASE WHEN form <> '' AND len(string_split(form, ' ')) >= 6
    THEN row_number() OVER (PARTITION BY form ORDER BY doc_id, place) > 1 END AS again
  FROM normal
), gone AS (
  SELECT doc_id, place, unit, coalesce(again,
    last_value(again IGNORE NULLS) OVER before AND first_value(again IGNORE NULLS) OVER after, false) AS away,
    sum(length(unit)) OVER (PARTITION BY doc_id ORDER BY place) - length(unit) AS pos
  FROM flags
  WINDOW before AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    after AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), runs AS (
  SELECT *, place - row_number() OVER (PARTITION BY doc_id, away ORDER BY place) AS run FROM gone
), spans AS (
  SELECT doc_id, string_agg(span, ',' ORDER BY begins) AS removed_spans FROM (
    SELECT doc_id, min(pos) AS begins, min(pos)::BIGINT || '-' || max(pos + length(unit))::BIGINT AS span
    FROM runs WHERE away GROUP BY doc_id, run) GROUP BY doc_id
), kept AS (
  SELECT doc_id, count(*) AS n_units, count(*) FILTER (away) AS n_removed,
    coalesce(string_agg(unit, '' ORDER BY place) FILTER (NOT away), '') AS rest
  FROM gone GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_units, 0)::BIGINT AS n_units, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(removed_spans, '') AS removed_spans, length(coalesce(rest, ''))::BIGINT AS n_kept_chars,
  sha256(coalesce(rest, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN spans USING (doc_id)
"""

#: Lengths, counts and covered words of repeated windows, then the thresholds one by one.
OP5_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), there AS (
  SELECT r, i, array_to_string(w[i : i + 7], ' ') AS words
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d)
), again AS (
  SELECT r, i FROM there QUALIFY count(*) OVER (PARTITION BY r, words) > 1
), covered AS (
  SELECT r, sum(own) AS n FROM (
    SELECT r, least(8, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 8)) AS own FROM again) GROUP BY r
), counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(w, lambda x: list_contains([STOP], x))) AS n_stop
  FROM d LEFT JOIN covered USING (r)
), based AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed_rules,
  NOT base_failed AND failed_rules = '' AS kept
FROM (SELECT *, concat_ws(',',
  CASE WHEN NOT coalesce(word_chars::DOUBLE / nullif(n_words, 0), 0) BETWEEN 1.5 AND 20 THEN 'mean_word' END,
  CASE WHEN coalesce(n_symbols::DOUBLE / nullif(word_chars, 0), 0) > 0.3 THEN 'symbols' END,
  CASE WHEN (n_stop + 1)::DOUBLE / (n_words + 1) < 0.02 THEN 'stop_words' END,
  CASE WHEN coalesce(n_dup_lines::DOUBLE / nullif(n_lines, 0), 0) > 0.5 THEN 'dup_lines' END) AS failed_rules
FROM based)
""".replace("STOP", ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS))

#: Every window of an item joined to every window of that length of every document.
OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), sought AS (
  SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS words
  FROM (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), there AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS words
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM sought))
), hits AS (
  SELECT r, i, n, item FROM there JOIN sought USING (n, words)
), covered AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r
), listed AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN listed USING (r)
"""

ORACLES: dict[str, str] = {"op5_quality_rules": OP5_SQL, "op9_unit_dedup": OP9_SQL, "op11_phrase_index": OP11_SQL}
