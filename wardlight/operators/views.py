"""Clinical feature views over clean encounters, and their 75-column whole.

Every view column is a function of the encounter's own row, so the whole is one
projection of one scan. ``patient_features_joined`` builds the same table by
joining the views, for callers that hold them as separate tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight import schema as S
from wardlight.functions import clinical as fn
from wardlight.operators.checks import require_unique

KEY = "encounter_id"
DIAGNOSES = ["diag_1", "diag_2", "diag_3"]
VISIT_COUNTS = ["number_inpatient", "number_emergency", "number_outpatient"]


def _age_columns() -> dict:
    age = F.col("age_midpoint")
    return {
        "age_category": fn.age_category(age),
        "is_senior": fn.flag(age >= 65),
        "is_geriatric": fn.flag(age >= 75),
    }


def _stay_columns() -> dict:
    days = F.col("time_in_hospital")
    return {
        "stay_category": fn.stay_category(days),
        "is_long_stay": fn.flag(days >= 7),
        "is_short_stay": fn.flag(days <= 2),
    }


def _with_code_parts(df: DataFrame) -> DataFrame:
    """Split each diagnosis code once; the groups and flags all read the parts."""
    heads = df.withColumns({f"_{d}_head": fn.code_head(F.col(d)) for d in DIAGNOSES})
    return heads.withColumns(
        {f"_{d}_number": fn.code_number(F.col(f"_{d}_head")) for d in DIAGNOSES}
    )


def _diagnosis_columns() -> dict:
    parts = {d: (F.col(f"_{d}_head"), F.col(f"_{d}_number")) for d in DIAGNOSES}
    columns = {
        name: fn.diagnosis_group(F.col(d), *parts[d])
        for name, d in zip(S.DIAGNOSIS_GROUP_COLUMNS, DIAGNOSES)
    }
    columns["has_diabetes_diagnosis"] = F.greatest(
        *[fn.flag(fn.is_diabetes_code(F.col(d))) for d in DIAGNOSES]
    )
    for group in ["Circulatory", "Respiratory", "Digestive", "Genitourinary"]:
        columns[f"has_{group.lower()}_diagnosis"] = F.greatest(
            *[fn.flag(fn.in_group(*parts[d], group)) for d in DIAGNOSES]
        )
    return columns


def _utilization_columns() -> dict:
    stays, emergencies, clinic = (F.coalesce(F.col(c), F.lit(0)) for c in VISIT_COUNTS)
    total = stays + emergencies + clinic
    return {
        "total_prior_visits": total,
        "has_prior_inpatient": fn.flag(stays > 0),
        "has_prior_emergency": fn.flag(emergencies > 0),
        "has_prior_outpatient": fn.flag(clinic > 0),
        "has_prior_visits": fn.flag(total > 0),
        "utilization_tier": fn.utilization_tier(total),
        "inpatient_frequency_tier": fn.inpatient_frequency_tier(stays),
    }


def _select(df: DataFrame, kept: list, derived: dict) -> DataFrame:
    return df.select(*kept, *[c.alias(name) for name, c in derived.items()])


def age_bins(clean: DataFrame) -> DataFrame:
    return _select(clean, [KEY, "patient_nbr", "age", "age_midpoint"], _age_columns())


def stay_categories(clean: DataFrame) -> DataFrame:
    return _select(clean, [KEY, "patient_nbr", "time_in_hospital"], _stay_columns())


def diagnosis_groups(clean: DataFrame) -> DataFrame:
    return _select(
        _with_code_parts(clean), [KEY, "patient_nbr", *DIAGNOSES], _diagnosis_columns()
    )


def prior_admissions(clean: DataFrame) -> DataFrame:
    counts = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in VISIT_COUNTS]
    return _select(clean, [KEY, "patient_nbr", *counts], _utilization_columns())


def patient_features(clean: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The 75 columns of the feature table in one projection, without a join.

    ``carry`` names further columns of ``clean`` to keep.
    """
    derived = {
        **_age_columns(),
        **_stay_columns(),
        **_diagnosis_columns(),
        **_utilization_columns(),
    }
    return _with_code_parts(clean).select(
        [
            derived[c].alias(c) if c in derived else F.col(c)
            for c in [*S.PATIENT_FEATURE_COLUMNS, *carry]
        ]
    )


def patient_features_joined(clean: DataFrame, allow_duplicates: bool = False) -> DataFrame:
    """The same table as a five-way join on the encounter id.

    An id that occurs n times comes out n**5 times, so by default repeated ids are
    refused (one aggregation over the id column). With unique ids no join key can
    be hot. Read ``clean`` from a table bucketed by encounter id
    (``sources.tables.write_clean_table``) and none of the joins shuffles. The joins merge:
    every side has a row per encounter, and a packed file's size, by which a plan would choose,
    makes millions of rows look small enough for the driver to broadcast.
    """
    if not allow_duplicates:
        require_unique(clean, KEY)
    views = [
        age_bins(clean).select(KEY, *S.AGE_BIN_COLUMNS),
        stay_categories(clean).select(KEY, *S.STAY_COLUMNS),
        diagnosis_groups(clean).select(KEY, *S.DIAGNOSIS_GROUP_COLUMNS, *S.DIAGNOSIS_FLAG_COLUMNS),
        prior_admissions(clean).select(KEY, *S.UTILIZATION_COLUMNS),
    ]
    # The narrow views meet first, so that the wide rows go through one join.
    derived = reduce(lambda a, b: a.join(b.hint("merge"), KEY), views)
    joined = clean.join(derived.hint("merge"), KEY)
    return joined.select(S.PATIENT_FEATURE_COLUMNS)


# Names the views are registered under.
VIEWS = {
    "age_bin_view": age_bins,
    "stay_category_view": stay_categories,
    "diagnosis_group_view": diagnosis_groups,
    "prior_admission_view": prior_admissions,
    "patient_features_view": patient_features,
}


def register_views(clean: DataFrame) -> None:
    """Make every view readable by name in this session."""
    for name, build in VIEWS.items():
        build(clean).createOrReplaceTempView(name)


def load_view(spark: SparkSession, name: str = "patient_features_view") -> DataFrame:
    return spark.table(name)
