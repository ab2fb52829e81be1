"""Integer encodings added to cleaned encounters. No shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.functions import clinical as fn


def encode_age_midpoint(df: DataFrame, source: str = "age", to: str = "age_midpoint") -> DataFrame:
    return df.withColumn(to, fn.age_midpoint(F.col(source)))


def encode_insulin(
    df: DataFrame,
    source: str = "insulin",
    to: str = "insulin_flag",
    active: Sequence[str] = fn.ACTIVE_INSULIN,
) -> DataFrame:
    return df.withColumn(to, fn.is_one_of(F.col(source), active))


def encode_medication_change(
    df: DataFrame, source: str = "change", to: str = "medication_change_flag", changed: str = fn.CHANGED
) -> DataFrame:
    return df.withColumn(to, fn.is_one_of(F.col(source), [changed]))


def encode_diabetes_medication(
    df: DataFrame,
    source: str = "diabetesmed",
    to: str = "diabetes_med_flag",
    prescribed: str = fn.PRESCRIBED,
) -> DataFrame:
    return df.withColumn(to, fn.is_one_of(F.col(source), [prescribed]))


def encode_target(
    df: DataFrame, source: str = "readmitted", to: str = "readmission_target"
) -> DataFrame:
    return df.withColumn(to, fn.readmission_target(F.col(source)))


def encode_encounters(df: DataFrame) -> DataFrame:
    """All five encodings in one projection."""
    return df.withColumns(
        {
            "age_midpoint": fn.age_midpoint(F.col("age")),
            "insulin_flag": fn.is_one_of(F.col("insulin"), fn.ACTIVE_INSULIN),
            "medication_change_flag": fn.is_one_of(F.col("change"), [fn.CHANGED]),
            "diabetes_med_flag": fn.is_one_of(F.col("diabetesmed"), [fn.PRESCRIBED]),
            "readmission_target": fn.readmission_target(F.col("readmitted")),
        }
    )
