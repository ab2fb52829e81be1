"""Nearest neighbours by vantage-point trees, one per shard.

Vectors are dealt to shards by a hash of their id. A shard's tree is built once and stored
as one row: at each node a vantage point, the median distance to it, and the two halves;
leaves hold up to ``leaf`` vectors. Queries go to every shard in blocks. At a node a query
enters first the half it lies in, then the other only if

    |distance to the vantage point - median| <= radius of its k nearest so far / factor

so a factor of one is the triangle inequality and gives exact results, and a larger one
prunes more. A whole block walks the tree together, so each visit is one matrix product.

Inner products become distances by one more coordinate: x goes to (x, sqrt(M^2 - |x|^2)),
M the largest norm, and a query to (q, 0); then the squared distance is
|q|^2 + M^2 - 2 q.x and the nearest have the largest product. Cosine scales vectors to
length one first; Euclidean distance needs neither. The final scores are computed on the
original vectors in double precision.

Equal vectors of a shard are one point of its tree with the ids that can matter, the k + 1
smallest, so a vector that a third of all rows share does not bend a tree.

Defined cases: vectors that are null, empty, all zero, of another length than most, or
with null or non-finite components take no part on either side; equal scores go to the
smaller id; with fewer candidates than k all are returned; rows that repeat an id are
candidates each; null ids take no part; an empty table gives no rows.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wardlight.llm.common import materialize

METRICS = ("inner", "cosine", "euclidean")
SLACK = 1e-9


def matrix_of(lists: pa.ListArray) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def exact_scores(metric: str, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """One query against rows, each summed in the same order wherever it stands."""
    if metric == "euclidean":
        return -np.sqrt(((rows - query) ** 2).sum(axis=1))
    products = (rows * query).sum(axis=1)
    if metric == "cosine":
        products = products / np.sqrt((rows * rows).sum(axis=1)) / np.sqrt((query * query).sum())
    return products


class Tree:
    """A vantage-point tree over distinct points. Nodes are tuples, leaves arrays of rows."""

    def __init__(self, points: np.ndarray, leaf: int = 0, root=None, seed: int = 7):
        self.points, self.leaf = points, leaf
        self.norms = (points * points).sum(axis=1)
        self.random = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(points))) if root is None else root

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        at = int(self.random.integers(len(rows)))
        vantage = rows[at]
        away = np.sqrt(((self.points[rows] - self.points[vantage]) ** 2).sum(axis=1))
        median = float(np.median(away))
        inner = away <= median
        if inner.all() or not inner.any():
            return rows
        return (int(vantage), median, self._build(rows[inner]), self._build(rows[~inner]))

    def search(self, queries: np.ndarray, k: int, factor: float) -> list[np.ndarray]:
        """For each query the rows of its k nearest points and all that tie with the last."""
        n = len(queries)
        self.queries, self.own = queries, (queries * queries).sum(axis=1)
        self.best = np.full((n, k), np.inf)
        self.found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(n)]
        self.factor, self.k = factor, k
        self.seen = 0
        self._visit(self.root, np.arange(n))
        out = []
        for q in range(n):
            away = np.concatenate([a for a, _ in self.found[q]] or [np.empty(0)])
            rows = np.concatenate([r for _, r in self.found[q]] or [np.empty(0, np.int64)])
            out.append(rows[away <= self.best[q, -1] * (1 + SLACK) + SLACK])
        return out

    def _squared(self, which: np.ndarray, rows: np.ndarray) -> np.ndarray:
        product = self.queries[which] @ self.points[rows].T
        return np.maximum(self.own[which][:, None] + self.norms[rows][None, :] - 2 * product, 0)

    def _visit(self, node, which: np.ndarray) -> None:
        if not len(which):
            return
        if not isinstance(node, tuple):
            self._leaf(node, which)
            return
        vantage, median, inner, outer = node
        away = np.sqrt(self._squared(which, np.array([vantage]))[:, 0])
        near = away <= median
        self._visit(inner, which[near])
        self._visit(outer, which[~near])
        radius = np.sqrt(self.best[which, -1]) / self.factor
        reach = np.abs(away - median) <= radius * (1 + SLACK) + 1e-6
        self._visit(outer, which[near & reach])
        self._visit(inner, which[~near & reach])

    def _leaf(self, rows: np.ndarray, which: np.ndarray) -> None:
        for at in range(0, len(which), 512):
            part = which[at : at + 512]
            away = self._squared(part, rows)
            self.seen += away.size
            k = min(self.k, away.shape[1])
            least = np.partition(away, k - 1, axis=1)[:, :k] if k < away.shape[1] else away
            both = np.concatenate([self.best[part], least], axis=1)
            self.best[part] = np.sort(both, axis=1)[:, : self.k]
            limit = self.best[part, -1] * (1 + SLACK) + SLACK
            q, r = np.nonzero(away <= limit[:, None])
            cuts = np.searchsorted(q, np.arange(len(part) + 1))
            for i, query in enumerate(part):
                mine = r[cuts[i] : cuts[i + 1]]
                if len(mine):
                    self.found[query].append((away[i, mine], rows[mine]))


def _lift(metric: str, rows: np.ndarray, top: float) -> np.ndarray:
    if metric == "euclidean":
        return rows
    if metric == "cosine":
        return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]
    rest = np.sqrt(np.maximum(top * top - (rows * rows).sum(axis=1), 0))
    return np.concatenate([rows, rest[:, None]], axis=1)


def _lift_queries(metric: str, rows: np.ndarray) -> np.ndarray:
    if metric == "inner":
        return np.concatenate([rows, np.zeros((len(rows), 1))], axis=1)
    return _lift(metric, rows, 0.0)


INDEX = "shard int, tree binary"


def _build_group(metric: str, top: float, leaf: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids = group["id"].to_numpy()
        rows = matrix_of(group["vector"].combine_chunks())
        order = np.lexsort((ids,))
        ids, rows = ids[order], rows[order]
        keys = np.ascontiguousarray(rows + 0.0).view(np.dtype((np.void, rows.shape[1] * 8)))[:, 0]
        _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        by_point = np.argsort(inverse, kind="stable")
        starts = np.searchsorted(inverse[by_point], np.arange(len(first) + 1))
        points = rows[first]
        lifted = _lift(metric, points, top)
        stored = {
            "root": Tree(lifted, leaf).root,
            "lifted": lifted,
            "points": points,
            "ids": ids[by_point],
            "starts": starts,
        }
        return pa.table(
            {
                "shard": pa.array([group["shard"][0].as_py()], pa.int32()),
                "tree": pa.array([pickle.dumps(stored)], pa.binary()),
            }
        )

    return run


FOUND = "query_id long, vec_id long, score double"


def _search_groups(metric: str, k: int, factor: float):
    def run(trees: pa.Table, block: pa.Table) -> pa.Table:
        queries, ids_out, scores_out = [], [], []
        if trees.num_rows and block.num_rows:
            stored = pickle.loads(trees["tree"][0].as_py())
            block = block.combine_chunks()
            query_ids = block["id"].to_numpy()
            rows = matrix_of(block["vector"].combine_chunks())
            # One more than k, since a query may meet itself.
            tree = Tree(stored["lifted"], root=stored["root"])
            hits = tree.search(_lift_queries(metric, rows), k + 1, factor)
            starts, ids = stored["starts"], stored["ids"]
            for query_id, query, points in zip(query_ids, rows, hits, strict=True):
                scores = exact_scores(metric, query, stored["points"][points])
                pairs = []
                for score, point in zip(scores.tolist(), points.tolist(), strict=True):
                    own = ids[starts[point] : starts[point + 1]]
                    own = own[own != query_id][:k]
                    pairs += [(-score, i) for i in own.tolist()]
                for negative, i in sorted(pairs)[:k]:
                    queries.append(query_id)
                    ids_out.append(i)
                    scores_out.append(-negative)
        return pa.table(
            {
                "query_id": pa.array(queries, pa.int64()),
                "vec_id": pa.array(ids_out, pa.int64()),
                "score": pa.array(scores_out, pa.float64()),
            }
        )

    return run


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id and vector as doubles, of the rows that take part, all of the commonest length."""
    read = vectors.select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")
    )
    fit = (
        F.col("id").isNotNull()
        & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    return read.filter(F.coalesce(fit, F.lit(False)))


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    metric: str = "inner",
    factor: float = 1.0,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = 8192,
    block_rows: int = 1024,
    leaf: int = 128,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of ``vectors`` to each of ``queries``,
    a row with the query's own id left out.

    Shards and blocks have a fixed size, so their number grows with the input, and each
    pair of a block and a shard is a task of its own. Scores are negative distances where
    the metric is Euclidean.
    """
    read = materialize(usable(vectors, key, vector), "vectors")
    sizes = read.groupBy(F.size("vector").alias("d")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))).alias("top"),
    )
    common = sizes.orderBy(F.desc("n"), "d").first()
    spark = vectors.sparkSession
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    read = read.filter(F.size("vector") == common["d"])
    shards = -(-common["n"] // shard_rows)
    dealt = read.withColumn("shard", F.pmod(F.xxhash64("id", "vector"), F.lit(shards)).cast("int"))
    top = common["top"] * (1 + 1e-12)
    trees = materialize(
        dealt.groupBy("shard").applyInArrow(_build_group(metric, top, leaf), INDEX), "vantage-trees"
    )
    asked = usable(queries, key, vector).filter(F.size("vector") == common["d"])
    blocks = -(-max(asked.count(), 1) // block_rows)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    all_shards = F.sequence(F.lit(0), F.lit(shards - 1).cast("int"))
    asked = asked.withColumn("shard", F.explode(all_shards))
    every_block = F.sequence(F.lit(0), F.lit(blocks - 1).cast("int"))
    spread = trees.withColumn("block", F.explode(every_block))
    found = (
        spread.groupBy("shard", "block")
        .cogroup(asked.groupBy("shard", "block"))
        .applyInArrow(_search_groups(metric, k, factor), FOUND)
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
