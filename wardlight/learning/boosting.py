"""Boosted trees of two classes, grown over packed bins: Spark's method, in less memory.

Spark's own fit keeps a 4-byte bin for every slot of every row and adds each of them up once for
every level of every tree. Here rows are packed in chunks: for each bin of a slot the rows that lie
in it, two bytes each, but for the slot's commonest bin, whose sums are the node's less those of the
others. A vector of blocks of one-hot slots thus costs a few dozen entries a row.

The tasks of one barrier stage (small tables: one task) keep their chunks in a temporary file and grow
all trees: each adds up its own rows by node and bin, the sums go round, and every task finds the same
split from them. A task's memory holds 28 bytes a row besides one chunk.

The method is Spark's: the same thresholds (from all rows up to 10,000, else from a sample of about
as many), the same gains, settings, stopping rules and losses, and the model is a
``GBTClassificationModel``. After the first tree, of splits whose gains differ by rounding only, the
first slot's is taken, where Spark's choice hangs on the order rows were added up in.
"""

from __future__ import annotations

import base64
import math
import pickle
import tempfile
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any, BinaryIO

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, TaskContext
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a chunk; row numbers within it take two bytes.
CHUNK_ROWS = 8_192
#: Up to so many rows one task grows the trees alone. A round of a barrier stage takes a second whatever
#: it sends, so 150 of them take about as long as such a table in one task (137 us a row for 150 levels as measured).
ALONE_ROWS = 1_000_000
#: A task of several takes about this many rows at least.
TASK_ROWS = 250_000
#: Sums of a pass, in bytes; nodes beyond that wait for another one.
PASS_BYTES = 16 << 20
#: What goes round at once, in bytes: all tasks' sums pass through the driver.
ROUND_BYTES = 32 << 20
#: Rows that thresholds are found from, as in Spark.
SAMPLE_ROWS = 10_000
#: Gains that differ by less than this share of the node's impurity are equal but for rounding.
ROUNDING = 1e-12


@dataclass(frozen=True)
class Bins:
    """Slots that have a threshold: their thresholds, the code of their first bin, their commonest bin."""

    size: int
    slots: np.ndarray
    thresholds: list[np.ndarray]
    first: np.ndarray
    common: np.ndarray

    @property
    def codes(self) -> int:
        return int(self.first[-1])


@dataclass
class Node:
    count: float = 0.0
    total: float = 0.0
    squares: float = 0.0
    gain: float = 0.0
    slot: int = -1  # its place in Bins.slots
    threshold: int = -1
    left: int = -1
    right: int = -1

    @property
    def mean(self) -> float:
        return self.total / self.count if self.count else 0.0

    @property
    def impurity(self) -> float:
        return (self.squares - self.total * self.total / self.count) / self.count if self.count else 0.0


#: A node split at last: itself, its child of the commonest bin, the codes of the rows that go to the
#: other child (first, end), and that child.
Branch = tuple[int, int, int, int, int]


@dataclass
class Tree:
    nodes: list[Node] = field(default_factory=lambda: [Node()])

    def split(self, i: int, found: tuple[int, int, float, float, float], bins: Bins) -> Branch:
        """Give the node two children."""
        node, new = self.nodes[i], len(self.nodes)
        node.slot, node.threshold, node.gain, count, total = found
        node.left, node.right = new, new + 1
        self.nodes += [Node(count, total), Node(node.count - count, node.total - total)]
        first, end = int(bins.first[node.slot]), int(bins.first[node.slot + 1])
        middle = first + node.threshold + 1
        if bins.common[node.slot] <= node.threshold:
            return i, node.left, middle, end, node.right
        return i, node.right, first, middle, node.left


# --- thresholds ----------------------------------------------------------------------


def _entries(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, slot and value of what vectors hold; sparse ones leave out zeros."""
    values = vectors.field("values")
    counts = np.diff(values.offsets.to_numpy())
    flat = values.flatten().to_numpy(zero_copy_only=False)
    if not np.isfinite(flat).all():
        raise ValueError("Vector values MUST NOT be NaN or Infinity")
    dense = np.repeat(vectors.field("type").to_numpy(zero_copy_only=False) == 1, counts)
    slots = np.empty(len(flat), np.int32)
    slots[~dense] = vectors.field("indices").flatten().to_numpy(zero_copy_only=False)
    if dense.any():
        begin = np.repeat(np.cumsum(counts) - counts, counts)
        slots[dense] = (np.arange(len(flat)) - begin)[dense]
    return np.repeat(np.arange(len(counts), dtype=np.int32), counts), slots, flat


def _thresholds(values: np.ndarray, weights: np.ndarray, expected: float, most: int) -> np.ndarray:
    """Thresholds of one slot, as Spark finds them: between all values, or at strides of their counts."""
    if len(values) <= most + 1:
        return (values[:-1] + values[1:]) / 2.0
    stride, found = expected / (most + 1), []
    passed, target = weights[0], stride
    for i in range(1, len(values)):
        before, passed = passed, passed + weights[i]
        if abs(before - target) < abs(passed - target):
            found.append((values[i - 1] + values[i]) / 2.0)
            target += stride
    return np.array(found)


def find_bins(rows: DataFrame, n: int, max_bins: int, seed: int) -> Bins:
    """Thresholds of every slot of the vectors ``v`` of ``n`` rows."""
    wanted = max(max_bins * max_bins, SAMPLE_ROWS)
    share = wanted / n if wanted < n else 1.0
    sample = (rows if share == 1.0 else rows.sample(False, share, seed)).select("v").toArrow()
    vectors = sample.column("v").combine_chunks()
    if isinstance(vectors, pa.ChunkedArray):
        vectors = pa.concat_arrays(vectors.chunks) if vectors.num_chunks else pa.array([], vectors.type)
    _, slots, values = _entries(vectors)
    first = rows.select(F.coalesce("v.size", F.size("v.values")).alias("n")).first()
    size = int(first["n"])
    held = values != 0
    slots, values = slots[held], values[held]
    order = np.lexsort((values, slots))
    slots, values = slots[order], values[order]
    ends = np.searchsorted(slots, np.arange(size + 1))
    expected, most = share * n, min(max_bins, n) - 1
    kept, thresholds, common = [], [], []
    for slot in range(size):
        mine = values[ends[slot] : ends[slot + 1]]
        if not len(mine):
            continue
        distinct, counts = np.unique(mine, return_counts=True)
        counts = counts.astype(float)
        zeros = expected - len(mine)
        if zeros > np.finfo(float).eps * len(mine) * 100:
            at = np.searchsorted(distinct, 0.0)
            distinct, counts = np.insert(distinct, at, 0.0), np.insert(counts, at, zeros)
        found = _thresholds(distinct, counts, expected, most)
        if not len(found):
            continue
        places = np.searchsorted(found, distinct, side="left")
        kept.append(slot)
        thresholds.append(found)
        common.append(int(np.bincount(places, weights=counts, minlength=len(found) + 1).argmax()))
    widths = np.array([len(t) + 1 for t in thresholds], np.int64)
    return Bins(size, np.array(kept, np.int32), thresholds, np.concatenate([[0], np.cumsum(widths)]).astype(np.int64), np.array(common, np.int64))


# --- packing -------------------------------------------------------------------------


def pack(vectors: pa.StructArray, bins: Bins) -> tuple[np.ndarray, np.ndarray]:
    """Rows of every code, ascending, and where each code begins; none for commonest bins."""
    n = len(vectors)
    rows, slots, values = _entries(vectors)
    order = np.argsort(slots.astype(np.uint16) if bins.size <= 1 << 16 else slots, kind="stable")
    rows, slots, values = rows[order].astype(np.uint16), slots[order], values[order]
    begins = np.searchsorted(slots, bins.slots, side="left")
    ends = np.searchsorted(slots, bins.slots, side="right")
    found, sizes = [], np.zeros(bins.codes, np.int64)
    for k, cuts in enumerate(bins.thresholds):
        mine, which = rows[begins[k] : ends[k]], np.searchsorted(cuts, values[begins[k] : ends[k]], side="left")
        if bins.common[k] != np.searchsorted(cuts, 0.0, side="left"):
            column = np.full(n, np.searchsorted(cuts, 0.0, side="left"))
            column[mine] = which
            mine, which = np.arange(n, dtype=np.uint16), column
        other = which != bins.common[k]
        mine, which = mine[other], which[other]
        if len(cuts) > 1:
            order = np.argsort(which.astype(np.uint16), kind="stable")
            mine = mine[order]
        found.append(mine)
        sizes[bins.first[k] : bins.first[k + 1]] = np.bincount(which, minlength=len(cuts) + 1)
    entries = np.concatenate(found) if found else np.zeros(0, np.uint16)
    return entries, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)


PACKED = "entries binary, starts binary, labels binary"


def _packer(shared: Any) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, CHUNK_ROWS):
                batch = whole.slice(begin, CHUNK_ROWS)
                # Taken rather than sliced: fields of a sliced struct keep the rows of the whole.
                vectors = batch.column(0).take(pa.array(np.arange(batch.num_rows)))
                labels = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int8)
                packed = (*pack(vectors, shared.value), labels)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes()], pa.binary()) for x in packed], names=["entries", "starts", "labels"]
                )

    return run


# --- a task's rows -----------------------------------------------------------------------


class Part:
    """The chunks of one task, in a file, and what each row has come to."""

    def __init__(self, file: BinaryIO, batches: Iterator[pa.RecordBatch], bins: Bins):
        self.file, self.bins, self.sizes, signs = file, bins, [], [np.zeros(0)]
        for batch in batches:
            for entries, starts, labels in zip(*(c for c in batch.columns), strict=True):
                file.write(starts.as_buffer())
                file.write(entries.as_buffer())
                signs.append(np.frombuffer(labels.as_buffer(), np.int8) * 2.0 - 1.0)
                self.sizes.append((len(signs[-1]), entries.as_buffer().size // 2))
        self.signs = np.concatenate(signs)
        self.margins = np.zeros(len(self.signs), float)
        self.target = self.signs.copy()
        self.at = np.zeros(len(self.signs), np.int32)

    def scan(
        self, branches: Sequence[Branch], nodes: int, asked: Sequence[int], finished: tuple[np.ndarray, float] | None
    ) -> np.ndarray:
        """Move rows along the branches; then sums of rows, targets and their squares for every node,
        and of rows and targets for each code of the nodes asked for.

        ``finished`` (each node's output, its weight) ends a tree: its nodes' sums come first, and the
        sums after them are those of the next tree, which is its root.
        """
        width, now = self.bins.codes, np.zeros((3, 1 if finished else nodes))
        past = np.zeros((3, nodes if finished else 0))
        by_code = np.zeros((2, len(asked) + 1, width))
        usual = np.arange(nodes, dtype=np.int32)
        for node, child, *_ in branches:
            usual[node] = child
        place = np.full(now.shape[1], len(asked) * width)
        place[list(asked)] = np.arange(len(asked)) * width
        self.file.seek(0)
        begin = 0
        for n, size in self.sizes:
            starts = np.frombuffer(self.file.read(4 * (width + 1)), np.int32)
            entries = np.frombuffer(self.file.read(2 * size), np.uint16).astype(np.intp)
            mine = slice(begin, begin + n)
            begin += n
            if branches:
                before, then = self.at[mine], usual[self.at[mine]]
                for node, _, first, end, child in branches:
                    rows = entries[starts[first] : starts[end]]
                    then[rows[before[rows] == node]] = child
                self.at[mine] = then
            if finished:
                past += _sums(self.at[mine], self.target[mine], nodes)
                output, weight = finished
                self.margins[mine] += weight * output[self.at[mine]]
                # The loss's falling slope: what the next tree is fitted to.
                sign = self.signs[mine]
                self.target[mine] = 4.0 * sign / (1.0 + np.exp(2.0 * sign * self.margins[mine]))
                self.at[mine] = 0
            at, target = self.at[mine], self.target[mine]
            now += _sums(at, target, now.shape[1])
            if not len(asked):
                continue
            if now.shape[1] == 1:
                sizes = np.diff(starts)
                added = np.add.reduceat(np.append(target[entries], 0.0), starts[:-1]) if width else np.zeros(0)
                by_code[0, 0] += sizes
                by_code[1, 0] += np.where(sizes > 0, added, 0.0)
                continue
            key = place[at][entries]
            key += np.repeat(np.arange(width), np.diff(starts))
            by_code[0] += np.bincount(key, minlength=by_code[0].size).reshape(by_code[0].shape)
            by_code[1] += np.bincount(key, target[entries], by_code[1].size).reshape(by_code[1].shape)
        return np.concatenate([past.ravel(), now.ravel(), by_code[:, : len(asked)].ravel()])


def _sums(at: np.ndarray, target: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(at, w, n) for w in (None, target, target * target)]).astype(float)


def _summed(mine: np.ndarray, tasks: int) -> np.ndarray:
    """All tasks' numbers added up in the order of tasks, so that each gets the same to the last bit."""
    if tasks == 1:
        return mine
    step, found = max(1, ROUND_BYTES // (8 * tasks)), []
    for begin in range(0, len(mine), step):
        sent = base64.b64encode(mine[begin : begin + step].tobytes()).decode()
        found.append(sum(np.frombuffer(base64.b64decode(x)) for x in BarrierTaskContext.get().allGather(sent)))
    return np.concatenate(found)


# --- growing -------------------------------------------------------------------------


def best_split(node: Node, counts: np.ndarray, totals: np.ndarray, bins: Bins, least: int, min_gain: float, signs: bool = False):
    """(slot's place, bin, gain, rows left, sum left) of the best split, or None.

    With ``signs`` targets are 1 and -1: sums are whole numbers, squares are counts, and gains come
    in Spark's own steps, so that equal and nearly equal ones are told apart as there.
    """
    if not len(bins.slots):
        return None
    begin, end = bins.first[:-1], bins.first[1:]
    common = begin + bins.common
    counts, totals = counts.copy(), totals.copy()
    counts[common] = node.count - np.add.reduceat(counts, begin)
    totals[common] = node.total - np.add.reduceat(totals, begin)
    gains, left_count, left_total = np.full(bins.codes, -np.inf), np.zeros(bins.codes), np.zeros(bins.codes)
    widths = end - begin
    for width in np.unique(widths):
        codes = begin[widths == width][:, None] + np.arange(width - 1)
        n, s = np.cumsum(counts[codes], axis=1), np.cumsum(totals[codes], axis=1)
        m, t = node.count - n, node.total - s
        with np.errstate(divide="ignore", invalid="ignore"):
            if signs:
                gain = node.impurity - n / node.count * ((n - s * s / n) / n) - m / node.count * ((m - t * t / m) / m)
            else:
                gain = (s * s / n + t * t / m - node.total * node.total / node.count) / node.count
        allowed = (n >= max(least, 1)) & (m >= max(least, 1))
        gains[codes] = np.where(allowed, gain, -np.inf)
        left_count[codes], left_total[codes] = n, s
    best = gains.max()
    slack = 0.0 if signs else ROUNDING * node.impurity
    if best <= slack or best < min_gain:
        return None
    code = int(np.argmax(gains >= best - slack))
    slot = int(np.searchsorted(bins.first, code, side="right")) - 1
    return slot, code - int(bins.first[slot]), float(gains[code]), left_count[code], left_total[code]


def grow(
    scan: Callable[[Sequence[Branch], int, Sequence[int], tuple[np.ndarray, float] | None], np.ndarray],
    bins: Bins,
    settings: dict[str, Any],
) -> list[Tree]:
    """Trees fitted one after another, from sums over all rows (``Part.scan``)."""
    most = max(1, PASS_BYTES // (16 * max(bins.codes, 1)))
    trees: list[Tree] = []
    branches: list[Branch] = []

    def passed(asked: Sequence[int], tree: Tree | None) -> np.ndarray:
        """The codes' sums of the nodes asked for; nodes get their own."""
        nonlocal branches
        last = trees[-1] if trees and (tree is None or len(tree.nodes) == 1) else None
        finished = None
        if last:
            finished = np.array([n.mean for n in last.nodes]), settings["stepSize"] if len(trees) > 1 else 1.0
        nodes = len((last or tree).nodes)
        sums, branches = scan(branches, nodes, asked, finished), []
        past, now, by_code = np.split(sums, np.cumsum([3 * nodes if last else 0, 3 * (1 if last else nodes)]))
        if last:
            _set_sums(last, past.reshape(3, -1), [i for i, n in enumerate(last.nodes) if n.left < 0])
        if tree:
            _set_sums(tree, now.reshape(3, -1), asked)
        return by_code.reshape(2, len(asked), bins.codes)

    for _ in range(settings["maxIter"]):
        tree, open_nodes = Tree(), [0]
        for _ in range(settings["maxDepth"]):
            split = []
            for begin in range(0, len(open_nodes), most):
                asked = open_nodes[begin : begin + most]
                by_code = passed(asked, tree)
                for k, i in enumerate(asked):
                    node = tree.nodes[i]
                    if abs(node.impurity) < np.finfo(float).eps:
                        continue
                    found = best_split(node, by_code[0, k], by_code[1, k], bins, settings["minInstancesPerNode"], settings["minInfoGain"], not trees)
                    if found:
                        split.append((i, found))
            branches = [tree.split(i, found, bins) for i, found in split]
            if not branches:
                break
            open_nodes = [c for i, _ in split for c in (tree.nodes[i].left, tree.nodes[i].right)]
        trees.append(tree)
    passed([], None)
    return trees


def _set_sums(tree: Tree, sums: np.ndarray, which: Sequence[int]) -> None:
    for i in which:
        tree.nodes[i].count, tree.nodes[i].total, tree.nodes[i].squares = (float(x) for x in sums[:, i])


def _grower(shared: Any) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, settings, tasks = shared.value
        with tempfile.TemporaryFile() as file:
            part = Part(file, batches, bins)
            trees = grow(lambda *asked: _summed(part.scan(*asked), tasks), bins, settings)
        if TaskContext.get().partitionId() == 0:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(trees)], pa.binary())], names=["trees"])

    return run


def boost(rows: DataFrame, n: int, settings: dict[str, Any]) -> tuple[list[Tree], Bins]:
    """Trees fitted to ``v`` (vectors as structs) and ``label`` (0 or 1) of ``n`` rows."""
    context = rows.sparkSession.sparkContext
    bins = find_bins(rows, n, settings["maxBins"], settings["seed"])
    # The tasks of a barrier stage run at once, so there are no more than the cluster has room for.
    tasks = 1 if n <= ALONE_ROWS else max(1, min(_room(context), math.ceil(n / TASK_ROWS)))
    shared, told = context.broadcast(bins), context.broadcast((bins, settings, tasks))
    chunks = rows.mapInArrow(_packer(shared), PACKED).repartition(tasks)
    found = chunks.mapInArrow(_grower(told), "trees binary", barrier=tasks > 1).collect()
    shared.destroy()
    told.destroy()
    return pickle.loads(found[0]["trees"]), bins


def _room(context: Any) -> int:
    scala = context._jsc.sc()
    return scala.maxNumConcurrentTasks(scala.resourceProfileManager().defaultResourceProfile())


# --- the model -----------------------------------------------------------------------


def _java_trees(spark: SparkSession, trees: Sequence[Tree], bins: Bins) -> list[Any]:
    """Root nodes as Spark's classes; two leaves of the same prediction become one, as in Spark."""
    jvm = spark._jvm
    spark_tree, copy_of = jvm.org.apache.spark.ml.tree, jvm.java.util.Arrays.copyOfRange
    leaf, internal, cut = spark_tree.LeafNode, spark_tree.InternalNode, spark_tree.ContinuousSplit
    calculator = jvm.org.apache.spark.mllib.tree.impurity.ImpurityCalculator.getCalculator
    # All sums travel at once: a call for each number would take most of a small fit's time.
    sums = [x for t in trees for n in t.nodes for x in (n.count, n.total, n.squares)]
    stats, begin, roots = _py2java(spark.sparkContext, DenseVector(sums)).toArray(), 0, []

    def built(tree: Tree, i: int) -> tuple[Any, bool, float]:
        node, at = tree.nodes[i], begin + 3 * i
        held = calculator("variance", copy_of(stats, at, at + 3), int(node.count))
        if node.left >= 0:
            (left, plain_left, mean_left), (right, plain_right, mean_right) = (built(tree, c) for c in (node.left, node.right))
            if not (plain_left and plain_right and mean_left == mean_right):
                split = cut(int(bins.slots[node.slot]), float(bins.thresholds[node.slot][node.threshold]))
                return internal(node.mean, node.impurity, node.gain, left, right, split, held), False, node.mean
            return leaf(mean_left, node.impurity, held), True, mean_left
        return leaf(node.mean, node.impurity, held), True, node.mean

    for tree in trees:
        roots.append(built(tree, 0)[0])
        begin += 3 * len(tree.nodes)
    return roots


class PackedGBT(GBTClassifier):
    """``GBTClassifier`` that grows its trees over packed bins.

    Categorical slots, weights, validation rows, and samples of rows or slots are left to Spark's own fit,
    as is a cluster that adds and drops executors as it runs: it cannot run a barrier stage.
    """

    def _packs(self, dataset: DataFrame) -> bool:
        attributes = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
        adds = dataset.sparkSession.sparkContext.getConf().get("spark.dynamicAllocation.enabled", "false")
        return (
            adds != "true"
            and not {"nominal", "binary"} & set(attributes)
            and self.getMaxDepth() > 0
            and self.getMaxIter() > 0
            and self.getSubsamplingRate() == 1.0
            and self.getFeatureSubsetStrategy() == "all"
            and not self.getMinWeightFractionPerNode()
            and not (self.isDefined(self.weightCol) and self.getWeightCol())
            and not (self.isDefined(self.validationIndicatorCol) and self.getValidationIndicatorCol())
        )

    def _rows(self, dataset: DataFrame) -> DataFrame:
        label, vector = F.col(self.getLabelCol()).cast("double"), F.col(self.getFeaturesCol())

        def refuse(text: str) -> Column:
            return F.raise_error(F.lit(text))

        checked = F.when(label.isNull() | F.isnan(label), refuse("Labels MUST NOT be Null or NaN").cast("double"))
        checked = checked.when(~label.isin(0.0, 1.0), refuse("Labels MUST be in {0, 1}").cast("double")).otherwise(label)
        whole = F.unwrap_udt(vector)
        kind = dataset.select(whole.alias("v")).schema["v"].dataType
        given = F.when(vector.isNull(), refuse("Vectors MUST NOT be Null").cast(kind)).otherwise(whole)
        return dataset.select(given.alias("v"), checked.alias("label"))

    def _fit(self, dataset: DataFrame):
        n = dataset.count() if self._packs(dataset) else 0
        if not n:
            return super()._fit(dataset)
        settings = {p: self.getOrDefault(p) for p in ("maxIter", "maxDepth", "stepSize", "maxBins", "minInstancesPerNode", "minInfoGain", "seed")}
        trees, bins = boost(self._rows(dataset), n, settings)
        spark = dataset.sparkSession
        jvm, gateway = spark._jvm, spark.sparkContext._gateway
        kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
        grown = gateway.new_array(kind, len(trees))
        weights = gateway.new_array(jvm.double, len(trees))
        for k, root in enumerate(_java_trees(spark, trees, bins)):
            grown[k] = kind(root, bins.size)
            weights[k] = settings["stepSize"] if k else 1.0
        self._transfer_params_to_java()
        java = jvm.org.apache.spark.ml.classification.GBTClassificationModel(self.uid, grown, weights, bins.size, 2)
        java.setParent(self._java_obj)
        self._java_obj.copyValues(java, self._java_obj.extractParamMap())
        return self._copyValues(self._create_model(java))
