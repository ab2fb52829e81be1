"""What each feature adds to a tree model's output: exact path-dependent Shapley values.

A leaf is reached with a row's own branches for the features known and in proportion to the
training rows for the others, so along one path each feature has a share z (of the rows that
its conditions let through) and an indicator o (whether this row meets them all). A leaf's
part of feature i is v (o - z) times a sum of the coefficients of the product of z + o t over
the other features, weighted as Shapley values are. That sum is polynomial in the path's
features. Rows that meet the same of a leaf's conditions share its parts, so a batch is a
table look-up for each leaf.

The outputs explained: the probability of class 1 for a decision tree and a random forest,
the margin (raw score) for boosted trees.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.learning.models import save_model
from wardlight.session import scratch_path


@dataclass(frozen=True)
class Leaf:
    """A path: its value times the tree's weight, and for each feature on it the share of rows
    its conditions keep and the conditions themselves: (threshold or categories, goes left)."""

    value: float
    features: tuple[int, ...]
    shares: np.ndarray
    conditions: tuple[tuple[tuple[Any, bool], ...], ...]


def _leaf_value(node, kind: str) -> float:
    if kind == "margin":
        return node["prediction"]
    stats = node["impurityStats"]
    return stats[1] / sum(stats) if sum(stats) else 0.0


def _leaves(nodes: dict[int, Any], kind: str, weight: float) -> Iterator[Leaf]:
    stack = [(0, {}, {})]
    while stack:
        at, shares, conditions = stack.pop()
        node = nodes[at]
        if node["leftChild"] < 0:
            features = tuple(shares)
            yield Leaf(
                weight * _leaf_value(node, kind), features, np.array([shares[f] for f in features]),
                tuple(tuple(conditions[f]) for f in features),
            )
            continue
        split = node["split"]
        feature, values = split["featureIndex"], list(split["leftCategoriesOrThreshold"])
        test = values[0] if split["numCategories"] < 0 else frozenset(values)
        for child, left in ((node["leftChild"], True), (node["rightChild"], False)):
            share = nodes[child]["rawCount"] / node["rawCount"] if node["rawCount"] else 0.0
            stack.append(
                (child, {**shares, feature: shares.get(feature, 1.0) * share},
                 {**conditions, feature: [*conditions.get(feature, ()), (test, left)]})
            )


def flatten(spark: SparkSession, model: Any) -> tuple[list[Leaf], float]:
    """The leaves of a fitted tree model, and its expected output.

    They are read from the model as it is stored; their number is bounded by the settings for
    trees and depth, not by data.
    """
    path = scratch_path(spark, "tree-model")
    save_model(model, path)
    stored = spark.read.parquet(f"{path}/data")
    if "nodeData" in stored.columns:
        rows = stored.select("treeID", "nodeData.*").collect()
        weights = list(model.treeWeights)
    else:
        rows, weights = stored.select(F.lit(0).alias("treeID"), "*").collect(), [1.0]
    boosted = type(model).__name__.startswith("GBT")
    kind = "margin" if boosted else "probability"
    total = 1.0 if boosted else sum(weights)
    trees: dict[int, dict[int, Any]] = {}
    for row in rows:
        trees.setdefault(row["treeID"], {})[row["id"]] = row
    leaves = [leaf for t, nodes in sorted(trees.items()) for leaf in _leaves(nodes, kind, weights[t] / total)]
    return leaves, float(sum(leaf.value * np.prod(leaf.shares) for leaf in leaves))


def _met(leaf: Leaf, column: dict[int, np.ndarray], n: int) -> np.ndarray:
    """Rows by features: whether all of the leaf's conditions on a feature hold."""
    met = np.ones((n, len(leaf.features)), bool)
    for k, (feature, conditions) in enumerate(zip(leaf.features, leaf.conditions, strict=True)):
        x = column[feature]
        for test, left in conditions:
            holds = np.isin(x, list(test)) if isinstance(test, frozenset) else x <= test
            met[:, k] &= holds if left else ~holds
    return met


def _parts(leaf: Leaf, met: np.ndarray) -> np.ndarray:
    """The leaf's part of each of its features, for each row of indicators."""
    n, m = met.shape
    o, z = met.astype(float), leaf.shares
    weight = [factorial(k) * factorial(m - k - 1) / factorial(m) for k in range(m)]
    out = np.empty((n, m))
    for i in range(m):
        product = np.zeros((n, m))  # coefficients of t^0 ... t^(m-1)
        product[:, 0] = 1.0
        for j in range(m):
            if j != i:
                moved = np.zeros_like(product)
                moved[:, 1:] = product[:, :-1]
                product = z[j] * product + o[:, j : j + 1] * moved
        out[:, i] = leaf.value * (o[:, i] - z[i]) * (product @ np.array(weight))
    return out


def shapley(leaves: Sequence[Leaf], column: dict[int, np.ndarray], n: int, used: Sequence[int]) -> np.ndarray:
    """Rows by ``used`` features."""
    out, at = np.zeros((n, len(used))), {f: k for k, f in enumerate(used)}
    for leaf in leaves:
        if not leaf.features or not leaf.value:
            continue
        met = _met(leaf, column, n)
        packed = np.packbits(met, axis=1)
        _, first, which = np.unique(packed, axis=0, return_index=True, return_inverse=True)
        out[:, [at[f] for f in leaf.features]] += _parts(leaf, met[first])[which.ravel()]
    return out


def tree_contributions(
    df: DataFrame,
    model: Any,
    slots: Sequence[tuple[str, str]] | None = None,
    key: str = "encounter_id",
    features: str = "features",
    to: str = "contributions",
) -> tuple[DataFrame, float]:
    """``key``, ``score`` (base and all contributions) and an array of (feature, contribution)
    for every row, largest first where ``slots`` of one column are added up; and the base.

    Give ``slots`` (``features.vector_slots``) to have names, one per column; else slots are named
    by number. Only slots that the trees ask for are sent to Python, in Arrow batches.
    """
    spark = df.sparkSession
    leaves, base = flatten(spark, model)
    used = sorted({f for leaf in leaves for f in leaf.features})
    names = [slots[f][0] if slots else f"slot {f}" for f in used]
    columns = list(dict.fromkeys(names))
    gathered = np.zeros((len(used), len(columns)))
    for k, name in enumerate(names):
        gathered[k, columns.index(name)] = 1.0
    asked: Column = F.array(*[F.get("_all", F.lit(f)) for f in used]).cast("array<double>")
    wide = df.select(key, vector_to_array(F.col(features)).alias("_all")).select(key, asked.alias("_x"))
    shared = spark.sparkContext.broadcast(leaves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, len(used))
            column = {f: x[:, k] for k, f in enumerate(used)}
            parts = shapley(shared.value, column, n, used) @ gathered
            flat = pa.array(parts.ravel(), pa.float64())
            offsets = pa.array(np.arange(0, n * len(columns) + 1, max(len(columns), 1))[: n + 1], pa.int32())
            score = pa.array(base + parts.sum(axis=1), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), score, pa.ListArray.from_arrays(offsets, flat)], names=[key, "score", "parts"]
            )

    kind = dict(df.dtypes)[key]
    if not used:
        found = df.select(key, F.lit(base).alias("score"), F.array().cast("array<double>").alias("parts"))
    else:
        found = wide.mapInArrow(run, f"`{key}` {kind}, score double, parts array<double>")
    named = F.zip_with(
        F.array(*[F.lit(c) for c in columns]).cast("array<string>"), "parts",
        lambda n, p: F.struct(n.alias("feature"), p.alias("contribution")),
    )
    return found.select(key, "score", F.filter(named, lambda e: e["contribution"] != 0).alias(to)), base
