"""Order-dependent results without putting a whole order into one task.

Rows are split at approximate quantiles of the ordering column, so every piece has
about the same number of rows whatever the distribution; results inside a piece
come from a window, and a table with one row per piece carries them across. The
split only decides where work happens: results are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlight.session import materialize, shuffle_width

PIECE = "_piece"


def split_points(df: DataFrame, column: str, pieces: int | None = None) -> list[float]:
    """Quantiles of a numeric column, at most ``pieces - 1`` of them. One job, no shuffle."""
    pieces = pieces or shuffle_width(df.sparkSession)
    wanted = [i / pieces for i in range(1, pieces)]
    ordered = df.select(F.col(column).cast("double").alias(column))
    found = ordered.approxQuantile(column, wanted, 0.25 / pieces) if wanted else []
    return sorted(set(found))


def with_piece(df: DataFrame, column: str, points: list[float]) -> DataFrame:
    """Number the piece each row belongs to; pieces follow the column's order."""
    if not points:
        return df.withColumn(PIECE, F.lit(0.0))
    borders = [float("-inf"), *points, float("inf")]
    return Bucketizer(
        splits=borders, inputCol=column, outputCol=PIECE, handleInvalid="keep"
    ).transform(df)


def running_before(total: Column, *groups: str) -> Column:
    """Sum of the earlier pieces' totals; one row per piece and group."""
    window = W.partitionBy(*groups).orderBy(PIECE).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(total).over(window), F.lit(0))


def rank_values(df: DataFrame, column: str, pieces: int | None = None) -> DataFrame:
    """One row per distinct value: its rows, the rows below it, and all rows.

    Equal values are counted before anything is ordered, so a value held by a large
    share of all rows is one row by then. The counts are stored once: ``df`` is read
    a single time for the split, the order and the totals.
    """
    known = df.select(column).filter(F.col(column).isNotNull())
    counts = materialize(
        known.groupBy(column).agg(F.count(F.lit(1)).alias("rows")), "value-counts"
    )
    points = split_points(counts, column, pieces)
    before = W.partitionBy(PIECE).orderBy(column).rowsBetween(W.unboundedPreceding, -1)
    ranked = with_piece(counts, column, points).withColumn(
        "_below", F.coalesce(F.sum("rows").over(before), F.lit(0))
    )
    totals = with_piece(counts, column, points).groupBy(PIECE).agg(
        F.sum("rows").alias("_piece_rows")
    )
    offsets = totals.select(
        PIECE,
        running_before(F.col("_piece_rows")).alias("_offset"),
        F.sum("_piece_rows").over(W.partitionBy()).alias("total_rows"),
    )
    return ranked.join(offsets, PIECE).select(
        column, "rows", (F.col("_below") + F.col("_offset")).alias("rows_below"), "total_rows"
    )


def with_previous(
    df: DataFrame, group: str, order: str, value: str, to: str, pieces: int | None = None
) -> DataFrame:
    """The value of the row before, in ``order``, within the group; NULL for the first.

    A group is cut into pieces of the order, so one that holds a third of all rows
    is spread over a third of the tasks. ``order`` must not repeat within a group.
    Give a stored frame: it is read three times.
    """
    split = with_piece(df, order, split_points(df, order, pieces))
    window = W.partitionBy(group, PIECE).orderBy(order)
    inside = split.withColumns(
        {"_lag": F.lag(value).over(window), "_first": F.row_number().over(window) == 1}
    )
    last = split.groupBy(group, PIECE).agg(F.max_by(value, order).alias("_last"))
    carried = last.select(
        group, PIECE, F.lag("_last").over(W.partitionBy(group).orderBy(PIECE)).alias("_carried")
    )
    joined = inside.join(carried, [group, PIECE], "left")
    previous = F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_lag"))
    return joined.select(*df.columns, previous.alias(to))


def number_rows(df: DataFrame, order: Sequence[str | Column], to: str, width: int | None = None) -> DataFrame:
    """Consecutive numbers from 0 over the whole frame in the given order, as a stored table.

    A range exchange puts neighbours together, each partition numbers its own rows, and a row
    for each partition carries the numbers on. Rows that are equal in the order are numbered
    one way or the other.
    """
    width = width or shuffle_width(df.sparkSession)
    inside = materialize(
        df.repartitionByRange(width, *order).sortWithinPartitions(*order).withColumn(
            "_place", F.monotonically_increasing_id()
        ),
        "numbered",
    ).withColumn(PIECE, F.shiftright("_place", 33))
    pieces = inside.groupBy(PIECE).agg(F.count(F.lit(1)).alias("_rows"))
    # One row for each partition of the exchange above.
    offsets = F.broadcast(pieces.select(PIECE, running_before(F.col("_rows")).alias("_offset")))
    number = F.col("_offset") + F.col("_place").bitwiseAND((1 << 33) - 1)
    return inside.join(offsets, PIECE).select(*df.columns, number.alias(to))
