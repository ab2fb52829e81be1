"""Joins to a side with unique keys that no hot key of the other side can slow down."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.session import materialize, shuffle_width


#: Values of the hash that keys are first counted by, for each partition of a shuffle.
SLOTS = 64


def join_spread(
    big: DataFrame,
    unique: DataFrame,
    keys: Sequence[str],
    counts: DataFrame | None = None,
    width: int | None = None,
    many_keys: bool = False,
) -> DataFrame:
    """``big`` left join ``unique``, whose keys do not repeat.

    A key is hot when it holds more than one in ``width`` of ``big``'s rows (default:
    the number of shuffle partitions), so there are fewer than ``width`` hot keys
    whatever the data. Their rows stay where they are and meet a broadcast of those
    few rows of ``unique``; all others join by shuffle. Without hot keys it is the
    plain join. ``counts`` gives ``_rows`` of ``big`` per key where they are known,
    best as a stored table. With ``many_keys``, for keys that nearly all differ, a hash of many
    times ``width`` values is counted first, which shuffles next to nothing; the keys themselves
    only where a value of the hash holds as much as a hot key does.
    """
    width = width or shuffle_width(big.sparkSession)
    if counts is None and many_keys:
        slot = F.pmod(F.xxhash64(*keys), F.lit(SLOTS * width))
        slots = big.groupBy(slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_rows"))
        seen = slots.agg(F.sum("_rows").alias("total"), F.max("_rows").alias("most")).first()
        if not seen["total"] or seen["most"] * width <= seen["total"]:
            return big.join(unique, list(keys), "left")
    if counts is None:
        counts = materialize(big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), "key-counts")
    seen = counts.agg(F.sum("_rows").alias("total"), F.max("_rows").alias("most")).first()
    if not seen["total"] or seen["most"] * width <= seen["total"]:
        return big.join(unique, list(keys), "left")

    hot = F.broadcast(
        counts.filter(F.col("_rows") * width > seen["total"]).select(
            *[F.col(k).alias(f"_hot_{k}") for k in keys]
        )
    )
    # Unknown keys may be many too; they count as a key here and match nothing below.
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    few = F.broadcast(unique.join(hot, same, "left_semi"))
    return (
        big.join(hot, same, "left_anti")
        .join(unique, list(keys), "left")
        .unionByName(big.join(hot, same, "left_semi").join(few, list(keys), "left"))
    )
