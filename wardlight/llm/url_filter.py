"""Url filter: rules first, then naive Bayes over words found inside host names.

Host names glue words together. Each run of letters in a distinct host is split by a
unigram Viterbi: the split whose words are likeliest together, where an unknown run is
charged by its length. The word counts come from a table of any size: the substrings of
the distinct hosts are joined to it, so no vocabulary is broadcast. A multinomial naive
Bayes over host words and path tokens then judges what no rule decides. Its examples are the urls
that rules decide, with the rules' verdicts as labels. Where no rule fits, a seed word among the
tokens makes a url an example of block and its absence one of allow, so words that keep company
with seeds count against a url too. One in ``HELD_OUT`` of the hosts is kept out of what is learned
from rules, so ``rule_error`` tells how often the model would have decided otherwise. Counts are kept
for each token by itself in a table that grows with the corpus: the weights are joined to the
tokens of distinct hosts and distinct paths, and only their totals reach the driver.

Defined cases: a url that is null or has no ``://`` has empty host and path, no token, and
is judged by the prior alone; without any url the prior is even; ties go to allow; repeated pages are judged each alone; a host that a third of
all pages share is segmented once and joined without a shuffle of its pages.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import materialize, one_of, rows_of
from wardlight.operators.spread import join_spread

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: No label of a host name is longer, so no longer piece is tried.
MAX_WORD = 63
HELD_OUT = 5
ALLOW, BLOCK = "allow", "block"
RUNS = re.compile(r"[^\W\d_]+|\d+")
NUMBER = "0"


# Words of host names that sell, bet, track or show adult content.
SEEDS = (
    "ad ads adult bet bets betting bingo casino cialis click clicks escort gambling jackpot loan loans "
    "lottery malware nude pharma phishing pill pills poker popup porn pron roulette sex slot slots spam "
    "torrent track tracker tracking viagra warez xxx"
).split()
#: How often a seed word is taken to occur beside its count in the texts.
SEED_COUNT = 1000


@dataclass(frozen=True)
class Rule:
    """``place`` is a host with a path behind it, such as ``example.org/en/``."""

    verdict: str
    place: str

    @property
    def host(self) -> str:
        return self.place.partition("/")[0]

    @property
    def path(self) -> str:
        return self.place[len(self.host) :]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct of its place and verdict; null without one."""
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r.place), r.place)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.place).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def word_counts(texts: DataFrame, column: str) -> DataFrame:
    """word, n: lower-case runs of letters outside of tags."""
    plain = F.lower(F.regexp_replace(F.col(column), "<[^>]*>", " "))
    words = texts.select(F.explode(F.split(plain, r"[^\p{L}]+")).alias("word"))
    return words.filter(F.length("word") > 0).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def split_word(run: str, cost_of: dict[str, float], unknown) -> list[str]:
    """The cheapest split of a run of letters (Viterbi); of equal ones, that with the longer last word."""
    best, back = [0.0], [0]
    for end in range(1, len(run) + 1):
        cheapest, at = math.inf, end - 1
        for start in range(max(0, end - MAX_WORD), end):
            piece = run[start:end]
            cost = best[start] + (cost_of[piece] if piece in cost_of else unknown(end - start))
            if cost < cheapest:
                cheapest, at = cost, start
        best.append(cheapest)
        back.append(at)
    words, end = [], len(run)
    while end:
        words.append(run[back[end] : end])
        end = back[end]
    return words[::-1]


def tokens_of(text: str) -> list[str]:
    """Runs of letters, and one token for any number."""
    return [NUMBER if t[0].isdigit() else t.lower() for t in RUNS.findall(text)]


def _pieces_task():
    schema = pa.schema([("host", pa.string()), ("word", pa.string())])

    def run(batches):
        for batch in batches:
            rows = (
                (host, piece)
                for host in one_of("host", batch)
                for piece in {
                    run[a:b]
                    for run in RUNS.findall(host)
                    if not run[0].isdigit()
                    for a in range(len(run))
                    for b in range(a + 1, min(len(run), a + MAX_WORD) + 1)
                }
            )
            yield from rows_of(schema, rows, 20_000)

    return run


def _segment_task(total: int):
    schema = pa.schema([("host", pa.string()), ("words", pa.list_(pa.string()))])
    whole = math.log(max(total, 1) + 1)

    def unknown(length: int) -> float:
        return whole + length * math.log(10.0)

    def run(batches):
        for batch in batches:
            rows = []
            for host, known in zip(one_of("host", batch), one_of("known", batch), strict=True):
                cost_of = {k["word"]: whole - math.log(k["n"]) for k in known or ()}
                words = [
                    w
                    for token in RUNS.findall(host)
                    for w in ([NUMBER] if token[0].isdigit() else split_word(token, cost_of, unknown))
                ]
                rows.append((host, words))
            yield from rows_of(schema, rows)

    return run


def segment_hosts(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """``host`` and ``words`` for each distinct host. ``counts`` (word, n) is read twice: store it."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    distinct = materialize(hosts.select("host").distinct(), "hosts")
    pieces = distinct.mapInArrow(_pieces_task(), "host string, word string")
    # Pieces such as "com" stand in most hosts.
    known = (
        join_spread(pieces, counts, ["word"])
        .filter(F.col("n").isNotNull())
        .groupBy("host")
        .agg(F.collect_list(F.struct("word", "n")).alias("known"))
    )
    return distinct.join(known, "host", "left").mapInArrow(
        _segment_task(total), "host string, words array<string>"
    )


def _path_tokens_task():
    def run(batches):
        for batch in batches:
            lists = [["p " + w for w in tokens_of(path)] for path in one_of("path", batch)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lists, pa.list_(pa.string()))], names=[*batch.schema.names, "tokens"]
            )

    return run


def url_parts(pages: DataFrame) -> DataFrame:
    """Distinct hosts and paths of ``pages`` (host, words, path, label): kind, part, tokens, the
    pages of either label that have the part, and a number. Host words and path tokens are told apart."""
    sums = [F.count(F.when(F.col("label") == c, 1)).alias(c) for c in (ALLOW, BLOCK)]
    hosts = pages.groupBy("host").agg(F.first("words").alias("words"), *sums).select(
        F.lit("host").alias("kind"),
        F.col("host").alias("part"),
        F.transform(F.coalesce("words", F.array().cast("array<string>")), lambda w: F.concat(F.lit("h "), w)).alias(
            "tokens"
        ),
        ALLOW,
        BLOCK,
    )
    paths = (
        pages.groupBy("path")
        .agg(*sums)
        .mapInArrow(_path_tokens_task(), f"path string, {ALLOW} long, {BLOCK} long, tokens array<string>")
        .select(F.lit("path").alias("kind"), F.col("path").alias("part"), "tokens", ALLOW, BLOCK)
    )
    numbered = hosts.unionByName(paths).withColumn("number", F.monotonically_increasing_id())
    return materialize(numbered, "url-parts")


def part_scores(parts: DataFrame, pseudo: float = 0.01) -> DataFrame:
    """kind, part and score: multinomial naive Bayes, the log odds of block against allow summed over
    the part's tokens. A token seen with one label only gets but a small pseudo-count for the other."""
    tokens = parts.select("number", ALLOW, BLOCK, F.explode("tokens").alias("token"))
    counts = materialize(
        tokens.groupBy("token").agg(
            F.sum(ALLOW).alias(ALLOW), F.sum(BLOCK).alias(BLOCK), F.count(F.lit(1)).alias("_rows")
        ),
        "token-counts",
    )
    n_allow, n_block, distinct = (
        x or 0 for x in counts.agg(F.sum(ALLOW), F.sum(BLOCK), F.count(F.lit(1))).first()
    )

    def share(label: str, total: int):
        return F.log((F.col(label) + pseudo) / F.lit(float(total + pseudo * distinct)))

    weights = counts.select("token", (share(BLOCK, n_block) - share(ALLOW, n_allow)).alias("weight"))
    met = join_spread(tokens.select("number", "token"), weights, ["token"], counts.select("token", "_rows"))
    # Added in order of size, so that the sum does not depend on the order in which rows arrive.
    total = F.aggregate(F.array_sort(F.collect_list("weight")), F.lit(0.0), lambda x, y: x + y)
    summed = met.groupBy("number").agg(total.alias("score"))
    return materialize(
        parts.join(summed, "number", "left").select("kind", "part", F.coalesce("score", F.lit(0.0)).alias("score")),
        "part-scores",
    )


def judge(
    pages: DataFrame,
    rules: list[Rule],
    counts: DataFrame,
    key: str = "page_id",
    url: str = "url",
    seeds=SEEDS,
) -> DataFrame:
    """Per row of ``pages``: key, host, path, rule, verdict, and the model's words, score (log odds
    of block), model_verdict, and held_out: whether a rule decides the row but was not learned from.
    ``counts`` has columns word and n; ``seeds`` are added to it."""
    spark = pages.sparkSession
    given = spark.range(1).select(
        F.explode(F.array(*[F.lit(w) for w in seeds])).alias("word"), F.lit(SEED_COUNT).cast("long").alias("n")
    )
    counts = counts.unionByName(given).groupBy("word").agg(F.sum("n").alias("n"))
    read = pages.select(
        F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    )
    read = read.withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    words = materialize(segment_hosts(read, materialize(counts, "word-counts")), "host-words")
    marked = F.arrays_overlap(
        F.concat("words", F.split(F.lower("path"), "[^a-z]+")), F.array(*[F.lit(w) for w in seeds])
    )
    split = materialize(
        join_spread(read, words, ["host"])
        .select("key", "host", "path", "found.rule", F.col("found.verdict").alias("given"), "words")
        .withColumn("held_out", F.col("given").isNotNull() & (F.crc32(F.encode("host", "utf-8")) % HELD_OUT == 0))
        .withColumn(
            "label",
            F.when(~F.col("held_out"), F.coalesce("given", F.when(marked, BLOCK).otherwise(ALLOW))),
        ),
        "url-words",
    )
    block, allow = split.agg(*[F.count(F.when(F.col("label") == c, 1)) for c in (BLOCK, ALLOW)]).first()
    prior = math.log((block + 1) / (allow + 1))
    scores = part_scores(url_parts(split))
    scored = split
    for part in ("host", "path"):
        own = scores.filter(F.col("kind") == part)
        scored = join_spread(
            scored, own.select(F.col("part").alias(part), F.col("score").alias(f"{part}_score")), [part]
        )
    scored = scored.withColumn("score", F.lit(prior) + F.col("host_score") + F.col("path_score"))
    own = F.when(F.col("score") > 0, BLOCK).otherwise(ALLOW)
    return scored.select(
        F.col("key").alias(key), "host", "path", "rule", F.coalesce("given", own).alias("verdict"), "words",
        "score", own.alias("model_verdict"), "held_out",
    )


def rule_error(judged: DataFrame) -> DataFrame:
    """Per verdict of a rule: how many held-out rows of ``judge`` it decides, and for how many of
    them the model says otherwise."""
    wrong = F.count(F.when(F.col("verdict") != F.col("model_verdict"), 1))
    return judged.filter("held_out").groupBy("verdict").agg(
        F.count(F.lit(1)).alias("n_held_out"), wrong.alias("n_wrong")
    )
