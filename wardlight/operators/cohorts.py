"""Cohort figures and prior-year visit history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlight.operators.spread import join_spread
from wardlight.session import materialize

VISIT_CLASSES = ["inpatient", "emergency", "outpatient"]


def cohort_rates(
    features: DataFrame,
    by: Sequence[str] = ("primary_diagnosis_group",),
    target: str = "readmission_target",
    subtotals: bool = False,
) -> DataFrame:
    """Encounters, readmissions and their share per cohort; with ``subtotals`` also
    for every prefix of the cohort columns, whose missing columns are NULL."""
    grouped = features.rollup(*by) if subtotals else features.groupBy(*by)
    return grouped.agg(
        F.count(F.lit(1)).alias("encounters"),
        F.sum(target).alias("readmissions"),
        F.avg(target).alias("readmission_rate"),
    )


def comorbidity_rates(
    features: DataFrame, flags: Sequence[str], target: str = "readmission_target"
) -> DataFrame:
    """Per comorbidity and whether it is present: encounters, readmission rate, mean
    prior visits, and the share of those visits that were inpatient. One pass."""
    long = features.select(
        target, "total_prior_visits", "number_inpatient", *flags
    ).unpivot([target, "total_prior_visits", "number_inpatient"], list(flags), "comorbidity", "present")
    visits = F.sum("total_prior_visits")
    return long.groupBy("comorbidity", "present").agg(
        F.count(F.lit(1)).alias("encounters"),
        F.avg(target).alias("readmission_rate"),
        F.avg("total_prior_visits").alias("mean_prior_visits"),
        F.when(visits > 0, F.sum(F.coalesce("number_inpatient", F.lit(0))) / visits)
        .otherwise(F.lit(0.0))
        .alias("inpatient_share"),
    )


def prior_year_visits(
    visits: DataFrame,
    patient: str = "patient_nbr",
    time: str = "admitted_at",
    visit_class: str = "visit_class",
    days: int = 365,
) -> DataFrame:
    """Visits per class in the ``days`` calendar days before each visit's own day.

    Visits are first counted per patient and day and the counts stored, so the window
    runs over days: a patient's rows there are bounded by the days on record, however
    many visits they have. The history then joins back to the visits on patient and
    day, apart from the shuffle for a patient's day that holds very many.
    """
    dated = visits.withColumn("_day", F.unix_date(F.to_date(time)))
    daily = materialize(
        dated.groupBy(patient, "_day").agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count_if(F.col(visit_class) == c).alias(f"_{c}") for c in VISIT_CLASSES],
        ),
        "daily-visits",
    )
    year = W.partitionBy(patient).orderBy("_day").rangeBetween(-days, -1)
    history = daily.select(
        patient,
        "_day",
        *[
            F.coalesce(F.sum(f"_{c}").over(year), F.lit(0)).alias(f"prior_{c}")
            for c in VISIT_CLASSES
        ],
    )
    return (
        join_spread(dated, history, [patient, "_day"], daily)
        .select(
            *visits.columns,
            *[F.coalesce(f"prior_{c}", F.lit(0)).alias(f"prior_{c}") for c in VISIT_CLASSES],
        )
        .withColumn("prior_total", sum((F.col(f"prior_{c}") for c in VISIT_CLASSES), F.lit(0)))
    )
