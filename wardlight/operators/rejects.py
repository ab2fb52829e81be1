"""Rules for single rows: one pass sorts rows into valid and rejected and counts each rule.

A rule is a name and a condition that must hold. A condition that is NULL does not hold, so
an unknown value is never taken for a good one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wardlight.functions import clinical as fn

BROKEN, REJECTED = "broken_rules", "rejected"


def intake_rules(low_stay: int = 1, high_stay: int = 14) -> dict[str, Column]:
    """What a raw encounter must fulfil to be of use to the feature views."""
    rules = {
        "id_given": F.col("encounter_id").isNotNull() & F.col("patient_nbr").isNotNull(),
        "gender_known": F.col("gender").isin("Female", "Male"),
        "age_readable": fn.age_midpoint(F.col("age")).isNotNull(),
        "not_terminal": ~F.col("discharge_disposition_id").isin(*fn.TERMINAL_DISCHARGE_IDS),
        "stay_in_range": F.col("time_in_hospital").between(low_stay, high_stay),
        "primary_diagnosis_given": fn.missing_to_null(F.col("diag_1")).isNotNull(),
        "readmission_known": F.col("readmitted").isin("NO", ">30", "<30"),
    }
    for c in ("number_outpatient", "number_emergency", "number_inpatient"):
        rules[f"{c}_given"] = F.col(c) >= 0
    return rules


def judge(df: DataFrame, rules: Mapping[str, Column], column: str = BROKEN) -> DataFrame:
    """The rows with the names of the rules they break, in the order of the rules. A projection."""
    named = [F.when(F.coalesce(holds, F.lit(False)), F.lit(None)).otherwise(F.lit(name)) for name, holds in rules.items()]
    return df.withColumn(column, F.array_compact(F.array(*named).cast("array<string>")))


def divert(df: DataFrame, rules: Mapping[str, Column], path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Write valid and rejected rows below ``path`` in one scan; give both and the counts.

    The counts (rows, rejected, and one for each rule) are observed while the rows are written.
    Rejected rows keep all columns and carry the names of their rules. Reading one side reads
    its own folder only.
    """
    taken = {BROKEN, REJECTED} & set(df.columns)
    if taken:
        raise ValueError(f"columns with names of the result: {sorted(taken)}")
    seen = Observation()
    judged = judge(df, rules).withColumn(REJECTED, F.size(BROKEN) > 0)
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if(REJECTED).alias(REJECTED)]
    counts += [F.count_if(F.array_contains(BROKEN, name)).alias(f"rule {name}") for name in rules]
    judged.observe(seen, *counts).write.mode("errorifexists").partitionBy(REJECTED).parquet(path)
    stored = df.sparkSession.read.schema(judged.schema).parquet(path)
    valid = stored.filter(~F.col(REJECTED)).drop(BROKEN, REJECTED)
    rejected = stored.filter(F.col(REJECTED)).drop(REJECTED)
    return valid, rejected, {k: v or 0 for k, v in seen.get.items()}
