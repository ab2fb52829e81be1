"""Sums over every subtree of a forest by parallel tree contraction, in rounds of joins.

Each round rakes all leaves into their parents and compresses unary chains: of the inner
nodes with one child left, a set without neighbours is cut out, and the child takes the
place below the grandparent, carrying what the removed node would have added. A node cut
out leaves one record: its sum is its child's plus a constant. When all nodes are gone, the
records are re-expanded in reverse, which gives the sums of the removed nodes.

Which chain nodes go: those whose depth has fewer factors of two than both neighbours', ties
by a hash of the id. A chain that is whole loses every second node in each round, any other
at least a third on average, so the work of all rounds together is in proportion to the tree,
and their number to the logarithm of its size. Joins meet unique keys on both sides; only the
sum over a parent's children has hot keys, and it is combined before it shuffles.

Defined cases: a node without a parent is a root; nulls among the values count as 0; an empty
forest gives no rows. Ids must not repeat, and a parent must be in the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import materialize


def _place(node: Column, depth: Column) -> Column:
    """The order in which chain nodes go: factors of two in the depth, then a hash."""
    twos = F.bit_count(depth.bitwiseAND(-depth) - 1)
    return F.struct(twos.alias("twos"), F.xxhash64(node).alias("mixed"), node.alias("node"))


def _round(active: DataFrame, n: int) -> DataFrame:
    """One rake and one compress. Rows: raked leaves, and the nodes still there, some of them
    with the record of the node cut out above them."""
    leaf = F.col("kids") == 0
    given = active.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(
        *[F.sum(F.when(leaf, F.col(f"w{i}") + F.col(f"x{i}"))).alias(f"g{i}") for i in range(n)],
        F.count_if(~leaf).alias("left"),
        F.min(F.when(~leaf, F.struct("id", "depth"))).alias("only"),
    )
    raked = active.filter(leaf)
    inner = active.filter(~leaf).join(given, "id")
    inner = inner.select(
        "id", "parent", "parent_depth", "depth", F.col("left").alias("kids"), "only",
        *[(F.col(f"w{i}") + F.coalesce(f"g{i}", F.lit(0))).alias(f"w{i}") for i in range(n)],
        *[f"x{i}" for i in range(n)],
    )
    own = _place(F.col("id"), F.col("depth"))
    chosen = (
        (F.col("kids") == 1)
        & F.col("parent").isNotNull()
        & (own < _place(F.col("only.id"), F.col("only.depth")))
        & (own < _place(F.col("parent"), F.col("parent_depth")))
    )
    cut = inner.filter(chosen).select(
        F.col("only.id").alias("id"), F.col("id").alias("gone"),
        F.col("parent").alias("up"), F.col("parent_depth").alias("up_depth"),
        *[F.col(f"w{i}").alias(f"gw{i}") for i in range(n)],
        *[F.col(f"x{i}").alias(f"gx{i}") for i in range(n)],
    )
    there = F.col("gone").isNotNull()
    kept = inner.filter(~F.coalesce(chosen, F.lit(False))).join(cut, "id", "left").select(
        "id",
        F.when(there, F.col("up")).otherwise(F.col("parent")).alias("parent"),
        F.when(there, F.col("up_depth")).otherwise(F.col("parent_depth")).alias("parent_depth"),
        "depth", "kids",
        *[f"w{i}" for i in range(n)],
        *[F.when(there, F.col(f"x{i}") + F.col(f"gw{i}") + F.col(f"gx{i}")).otherwise(F.col(f"x{i}")).alias(f"x{i}")
          for i in range(n)],
        F.lit(False).alias("raked"),
        "gone",
        *[(F.col(f"x{i}") + F.col(f"gw{i}")).alias(f"k{i}") for i in range(n)],
    )
    return kept.unionByName(raked.withColumn("raked", F.lit(True)), allowMissingColumns=True)


def subtree_sums(tree: DataFrame, values: list[str]) -> DataFrame:
    """``id`` and, under their own names, the sums of ``values`` (long) over its subtree.

    ``tree`` has ``id``, ``parent`` (null for a root), ``depth`` (0 for a root, else the
    parent's and one) and the values.
    """
    n = len(values)
    counts = tree.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("kids"))
    active = tree.join(counts, "id", "left").select(
        "id", "parent", (F.col("depth") - 1).alias("parent_depth"), "depth",
        F.coalesce("kids", F.lit(0)).alias("kids"),
        *[F.coalesce(F.col(v).cast("long"), F.lit(0)).alias(f"w{i}") for i, v in enumerate(values)],
        *[F.lit(0).cast("long").alias(f"x{i}") for i in range(n)],
    )
    active = materialize(active, "tree")
    state = active.columns
    raked, records = [], []
    while True:
        done = materialize(_round(active, n), "tree-round")
        raked.append(done.filter("raked").select("id", *[F.col(f"w{i}").alias(f"t{i}") for i in range(n)]))
        active = done.filter("NOT raked").select(*state)
        left = done.agg(F.count_if(~F.col("raked")).alias("nodes"), F.count("gone").alias("cut")).first()
        records.append(
            done.filter("gone IS NOT NULL").select("id", "gone", *[f"k{i}" for i in range(n)]) if left["cut"] else None
        )
        if not left["nodes"]:
            break
    # What was cut out in a round has its child's sum from a later one.
    known = []
    for leaves, cut in zip(reversed(raked), reversed(records), strict=True):
        if cut is not None:
            later = reduce(DataFrame.unionByName, known)
            found = cut.join(later, "id").select(
                F.col("gone").alias("id"), *[(F.col(f"t{i}") + F.col(f"k{i}")).alias(f"t{i}") for i in range(n)]
            )
            known.append(materialize(found, "tree-sums"))
        known.append(leaves)
    return reduce(DataFrame.unionByName, known).select(
        "id", *[F.col(f"t{i}").alias(v) for i, v in enumerate(values)]
    )
