"""Connected components of a table of links, in a few rounds of joins.

Each round hangs the larger neighbours of every node on its smallest neighbour, then the
smaller ones; the links left at the end are stars whose centre is the smallest node.
Every round is written to the shared folder, which ends its lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import materialize


def _star(links: DataFrame, larger: bool) -> DataFrame:
    if larger:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    met = both.join(least, "a")
    if larger:
        hung = met.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        hung = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return hung.filter(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of links (a, b) that is not
    its component's smallest. Nodes are numbers; links to itself and repeats do no harm."""
    links = materialize(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter(F.col("a") != F.col("b"))
        .distinct(),
        "links",
    )
    mark = None
    while True:
        found = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(found) == mark or not found[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = tuple(found)
        links = materialize(_star(_star(links, True), False), "links")
