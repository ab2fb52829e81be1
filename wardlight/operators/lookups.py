"""Diagnosis codes looked up in a table of code ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.functions import clinical as fn
from wardlight.operators.spread import join_spread
from wardlight.session import materialize

POSITIONS = {"diag_1": "primary", "diag_2": "secondary", "diag_3": "additional"}
#: Characters of a code that ranges can tell apart; codes are read in base 36.
CODE_WIDTH = 7
BASE = 36


def standard_ranges(spark: SparkSession) -> DataFrame:
    """The clinical groups as ``low, high, diagnosis_group`` rows."""
    diabetes = int(fn.DIABETES_PREFIX)
    rows = [(diabetes, diabetes, "Diabetes")]
    for group, low, high, symptom in fn.DIAGNOSIS_RANGES:
        rows.append((low, high, group))
        if symptom:
            rows.append((int(symptom), int(symptom), group))
    return spark.createDataFrame(rows, "low int, high int, diagnosis_group string")


def long_diagnoses(encounters: DataFrame) -> DataFrame:
    """One row per encounter and diagnosis position."""
    return encounters.select(
        "encounter_id",
        F.stack(
            F.lit(len(POSITIONS)),
            *[x for c, name in POSITIONS.items() for x in (F.lit(name), F.col(c))],
        ).alias("position", "code"),
    )


def diagnosis_range_join(encounters: DataFrame, ranges: DataFrame) -> DataFrame:
    """Group of every diagnosis by the range its number falls in.

    A range becomes its integer codes, which turns the range condition into an
    equality that hashes instead of comparing each row with each range. Overlapping
    ranges give one row each. Codes outside every range are 'Other', absent ones
    'Missing'. Codes that very many rows have are met where they are.
    """
    codes = (
        ranges.select(F.explode(F.sequence("low", "high")).alias("_number"), "diagnosis_group")
        .groupBy("_number")
        .agg(F.collect_list("diagnosis_group").alias("_groups"))
    )
    long = long_diagnoses(encounters).withColumn(
        "_number", fn.code_number(fn.code_head(F.col("code")))
    )
    missing = F.col("code").isNull() | F.trim("code").isin("", fn.MISSING_TOKEN)
    return join_spread(long, codes, ["_number"]).withColumn(
        "diagnosis_group", F.explode_outer("_groups")
    ).select(
        "encounter_id",
        "position",
        "code",
        F.when(missing, "Missing")
        .otherwise(F.coalesce("diagnosis_group", F.lit("Other")))
        .alias("diagnosis_group"),
    )


def code_text(code: Column) -> Column:
    """A code as the characters it is ordered by: upper case, no dot or blank, and numbers
    before the dot with three digits at least. NULL for what has other characters, or none,
    or more than can be told apart."""
    trimmed = F.upper(F.trim(code))
    head, tail = F.substring_index(trimmed, ".", 1), F.regexp_extract(trimmed, r"\.(.*)$", 1)
    padded = F.when(head.rlike(r"^\d{1,2}$"), F.lpad(head, 3, "0")).otherwise(head)
    text = F.concat(padded, F.replace(tail, F.lit("."), F.lit("")))
    return F.when(text.rlike(f"^[0-9A-Z]{{1,{CODE_WIDTH}}}$"), text)


def code_place(text: Column, fill: str = "0") -> Column:
    """The place of such a text among all: filled up with its first or last successor."""
    return F.conv(F.rpad(text, CODE_WIDTH, fill), BASE, 10).cast("long")


def range_blocks(ranges: DataFrame) -> DataFrame:
    """Ranges cut into whole blocks of codes with a common beginning: level, block and the
    range's columns. At most 70 blocks for each of seven levels, however wide a range is."""
    low, high = code_place(code_text(F.col("low"))), code_place(code_text(F.col("high")), "Z")
    parts = []
    for level in range(CODE_WIDTH):
        size, wider = BASE**level, BASE ** (level + 1)
        first = F.ceil(F.col("_low") / size).cast("long")
        last = F.floor((F.col("_high") + 1) / size).cast("long") - 1
        up_first = F.ceil(F.col("_low") / wider).cast("long") * BASE
        up_last = (F.floor((F.col("_high") + 1) / wider).cast("long")) * BASE - 1
        none = F.array().cast("array<long>")

        def run(a: Column, b: Column) -> Column:
            return F.when(a <= b, F.sequence(a, b)).otherwise(none)  # noqa: B023

        inside = up_first <= up_last if level + 1 < CODE_WIDTH else F.lit(False)
        blocks = F.when(inside, F.concat(run(first, up_first - 1), run(up_last + 1, last))).otherwise(run(first, last))
        parts.append(F.transform(blocks, lambda b: F.struct(F.lit(level).alias("level"), b.alias("block"))))  # noqa: B023
    placed = ranges.withColumns({"_low": low, "_high": high}).filter("_low <= _high")
    return placed.withColumn("_part", F.explode(F.concat(*parts))).select(*ranges.columns, "_part.*")


def interval_join(rows: DataFrame, ranges: DataFrame, code: str = "code", group: str = "diagnosis_group") -> DataFrame:
    """Every row with every range its code lies in, NULL for none: ICD-9 and ICD-10, decimals too.

    ``ranges`` has ``low``, ``high`` (both included, with all codes that begin like ``high``) and
    the group. Ranges become blocks and each distinct code its own beginnings, so the condition
    is an equality of beginnings; a code's groups then go to its rows, hot codes where they are.
    """
    counts = materialize(rows.groupBy(code).agg(F.count(F.lit(1)).alias("_rows")), "code-counts")
    places = counts.select(code, code_place(code_text(F.col(code))).alias("_place")).filter("_place IS NOT NULL")
    beginnings = F.array(
        *[F.struct(F.lit(k).alias("level"), F.floor(F.col("_place") / BASE**k).cast("long").alias("block")) for k in range(CODE_WIDTH)]
    )
    beginning = places.select(code, F.explode(beginnings).alias("_part")).select(code, "_part.*")
    known = (
        range_blocks(ranges.select("low", "high", group))
        .join(beginning, ["level", "block"])
        .groupBy(code)
        .agg(F.sort_array(F.collect_set(group)).alias("_groups"))
    )
    return (
        join_spread(rows, known, [code], counts)
        .withColumn(group, F.explode_outer("_groups"))
        .select(*rows.columns, group)
    )
