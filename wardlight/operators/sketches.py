"""Mergeable summaries of each day and cohort, stored once and merged for any span of days.

A row of the sketch table holds, for one day and cohort, the number of rows, a KLL sketch of a
whole-number measure (ranks, percentiles) and an HLL sketch of who was seen (distinct persons).
Any span and any coarser cohort is a merge of those rows and reads no encounter again. Sketches
have a fixed size, so a day's rows are as many as its cohorts, whatever their traffic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A KLL sketch of this size gives ranks within 1.65 % at 99 % confidence.
KLL_SIZE, RANK_ERROR = 200, 0.0165
#: An HLL sketch of 2^12 cells: three standard errors of a count of persons.
HLL_BITS, COUNT_ERROR = 12, 3 * 1.04 / 2**6


def daily_sketches(df: DataFrame, day: str, cohort: Sequence[str], measure: str, person: str) -> DataFrame:
    """day, the cohort's columns, n_rows, values_sketch, persons_sketch. NULL measures and persons
    are left out of their sketches (which are NULL where nothing is left), and counted in n_rows;
    NULL days and cohorts are cohorts of their own. Combined before it is shuffled."""
    value = F.col(measure).cast("long")
    return df.groupBy(F.col(day).cast("date").alias("day"), *cohort).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.when(F.count(value) > 0, F.kll_sketch_agg_bigint(value, F.lit(KLL_SIZE))).alias("values_sketch"),
        F.hll_sketch_agg(F.col(person), F.lit(HLL_BITS)).alias("persons_sketch"),
    )


def store_sketches(sketches: DataFrame, path: str) -> None:
    """Write the days at hand; a day that is stored already is replaced as a whole, other days are
    left alone, so a day may be summed up again."""
    (
        sketches.repartition("day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )


def read_sketches(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Stored sketches of the days from ``first`` to ``last``; only their folders are read."""
    stored = spark.read.parquet(path)
    if first is not None:
        stored = stored.filter(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        stored = stored.filter(F.col("day") <= F.lit(last).cast("date"))
    return stored


def merge_sketches(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row for each value of ``by`` (all rows: one), of the same form as a day's."""
    return sketches.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"),
        F.when(F.count("values_sketch") > 0, F.kll_merge_agg_bigint("values_sketch")).alias("values_sketch"),
        F.hll_union_agg("persons_sketch").alias("persons_sketch"),
    )


def summary(merged: DataFrame, percentiles: Sequence[float] = (0.5, 0.9)) -> DataFrame:
    """The sketches read out: n_values, least and greatest (exact), ``p50`` and so on, n_persons."""
    sketch = F.col("values_sketch")
    given = lambda c: F.when(sketch.isNotNull(), c)
    rank = lambda q: given(F.kll_sketch_get_quantile_bigint(sketch, F.lit(float(q))))
    kept = [c for c in merged.columns if c not in ("values_sketch", "persons_sketch")]
    return merged.select(
        *kept,
        F.coalesce(given(F.kll_sketch_get_n_bigint(sketch)), F.lit(0)).alias("n_values"),
        rank(0).alias("least"),
        rank(1).alias("greatest"),
        *[rank(q).alias(f"p{100 * q:g}") for q in percentiles],
        F.hll_sketch_estimate("persons_sketch").alias("n_persons"),
    )
