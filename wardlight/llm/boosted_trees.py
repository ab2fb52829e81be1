"""Histogram gradient-boosted trees over document statistics.

Statistics of a text are Spark columns. A bounded number of labelled rows, those with the
smallest hashes of their id, comes to the driver for training: statistics are binned at
their quantiles, each level of a tree is grown from histograms of gradients, and trees are
flattened into arrays laid out as complete binary trees. Scoring walks all rows of a batch
down all trees at once with numpy, in the tasks that read the texts; no shuffle.

Defined cases: a null text counts as empty, and an empty one is scored from its
statistics as any other; without training rows, or with one class only, every score is the
smoothed share of label 1; rows that repeat are scored alike; null ids or labels are never
trained on; columns other than the id and the text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.llm.quality_rules import measures

#: The most labelled rows that training takes; more would not change trees of this size.
TRAIN_ROWS = 20_000


@dataclass
class Trees:
    """Complete binary trees as arrays: row t holds tree t, node n has children 2n+1 and 2n+2."""

    base: float
    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.features.shape[1]
        for features, cuts, leaves in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            while inner and node[0:1].size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, features[node]] > cuts[node])
            total += leaves[node - inner]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -40, 40)))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15,
    least_rows: int = 10, ridge: float = 1.0,
) -> Trees:
    """Logistic loss, second-order gains, every level grown from one histogram per statistic."""
    n, width = x.shape
    share = (y.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    inner = 2**depth - 1
    none = Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if n < 2 * least_rows or y.min() == y.max():
        return none
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    margin = np.full(n, base)
    grown = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = p - y, p * (1 - p)
        features, cuts = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            cell = (node - first)[:, None] * bins + binned
            best = np.full(count, 1e-6)
            for j in range(width):
                shape = (count, bins)
                g = np.bincount(cell[:, j], gradient, count * bins).reshape(shape).cumsum(axis=1)
                h = np.bincount(cell[:, j], hessian, count * bins).reshape(shape).cumsum(axis=1)
                m = np.bincount(cell[:, j], minlength=count * bins).reshape(shape).cumsum(axis=1)
                whole_g, whole_h, whole_m = g[:, -1:], h[:, -1:], m[:, -1:]
                gain = (
                    g**2 / (h + ridge)
                    + (whole_g - g) ** 2 / (whole_h - h + ridge)
                    - whole_g**2 / (whole_h + ridge)
                )
                gain[(m < least_rows) | (whole_m - m < least_rows)] = -1
                gain = gain[:, : len(edges[j])]
                if not gain.size:
                    continue
                at = gain.argmax(axis=1)
                top = gain[np.arange(count), at]
                for k in np.flatnonzero(top > best):
                    best[k], features[first + k], cuts[first + k] = top[k], j, edges[j][at[k]]
            node = 2 * node + 1 + (x[np.arange(n), features[node]] > cuts[node])
        slot = node - inner
        g = np.bincount(slot, gradient, inner + 1)
        h = np.bincount(slot, hessian, inner + 1)
        leaves = -rate * g / (h + ridge)
        margin += leaves[slot]
        grown.append((features, cuts, leaves))
    return Trees(base, *(np.stack(part) for part in zip(*grown, strict=True)))


def ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


STATISTICS = (
    "n_words", "word_chars", "mean_word_chars", "symbol_ratio", "stop_ratio", "dup_line_ratio",
    "repeat_ratio", "words_per_line", "upper_ratio", "digit_ratio", "stop_mark_ratio", "bar_ratio",
    "exclaim_ratio", "comma_ratio",
)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the statistics as columns, all native."""
    whole = F.coalesce(F.col(text), F.lit(""))

    def share(pattern: str) -> Column:
        return F.length("_s") - F.length(F.translate("_s", pattern, ""))

    marked = docs.withColumn("_s", whole).withColumns(
        {
            "_upper": share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
            "_digit": share("0123456789"),
            "_stop": share("."),
            "_bar": share("|"),
            "_exclaim": share("!"),
            "_comma": share(","),
        }
    )
    found = measures(marked.drop("_s"), text)
    parts = {
        "repeat_ratio": ratio(F.col("n_repeat_words"), F.col("n_words")),
        "words_per_line": ratio(F.col("n_words"), F.col("n_lines")),
        "upper_ratio": ratio(F.col("_upper"), F.col("word_chars")),
        "digit_ratio": ratio(F.col("_digit"), F.col("word_chars")),
        "stop_mark_ratio": ratio(F.col("_stop"), F.col("n_words")),
        "bar_ratio": ratio(F.col("_bar"), F.col("n_words")),
        "exclaim_ratio": ratio(F.col("_exclaim"), F.col("n_words")),
        "comma_ratio": ratio(F.col("_comma"), F.col("n_words")),
    }
    return found.withColumns(parts)


def _vector() -> Column:
    return F.array(*[F.col(c).cast("double") for c in STATISTICS])


def train(docs: DataFrame, labels: DataFrame, most_rows: int = TRAIN_ROWS, **settings) -> Trees:
    """From ``labels`` (doc_id, label), already without what must stay unseen."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    # The limit bounds what is broadcast and what comes to the driver.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    taken = statistics(rows).select("doc_id", "label", _vector().alias("x"))
    found = taken.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most_rows).toPandas()
    x = np.array(found["x"].tolist(), np.float64).reshape(len(found), len(STATISTICS))
    return fit(x, found["label"].to_numpy(dtype=np.float64), **settings)


def _score_task(model):
    def run(batches):
        trees = model.value
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("_x"))
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
            others = [i for i, name in enumerate(batch.schema.names) if name != "_x"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in others] + [pa.array(trees.probability(x), pa.float64())],
                names=[batch.schema.names[i] for i in others] + ["score"],
            )

    return run


def score(docs: DataFrame, trees: Trees, *keep: str, text: str = "text") -> DataFrame:
    """The columns ``keep`` of every row and its score."""
    held = docs.select(F.struct(*keep).alias("_kept"), F.col(text).alias("text"))
    spark = docs.sparkSession
    wide = statistics(held).select("_kept.*", _vector().alias("_x"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide.schema[:-1])
    return wide.mapInArrow(_score_task(spark.sparkContext.broadcast(trees)), f"{schema}, score double")
