"""Clinical scalar expressions as Columns.

All are null-safe under ANSI mode: text that is not a number becomes NULL instead of
failing the job. Text is tested before it is cast, since a ``try_cast`` that fails
raises and catches an exception for every such row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the raw coding.
MISSING_TOKEN = "?"
TERMINAL_DISCHARGE_IDS = (11, 13, 14, 19, 20, 21)
INVALID_GENDERS = ("Unknown/Invalid",)
ACTIVE_INSULIN = ("Up", "Down", "Steady")
CHANGED = "Ch"
PRESCRIBED = "Yes"

# Integer ICD-9 ranges and symptom code of each group, in the order
# they are tried.
DIAGNOSIS_RANGES = [
    ("Circulatory", 390, 459, "785"),
    ("Respiratory", 460, 519, "786"),
    ("Digestive", 520, 579, "787"),
    ("Genitourinary", 580, 629, "788"),
    ("Musculoskeletal", 710, 739, None),
    ("Neoplasms", 140, 239, None),
    ("Injury", 800, 999, None),
]
DIABETES_PREFIX = "250"


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def missing_to_null(c: Column, token: str = MISSING_TOKEN) -> Column:
    """NULL for the missing marker, the untouched value otherwise."""
    return F.when(F.trim(c) == token, F.lit(None)).otherwise(c)


def age_midpoint(c: Column) -> Column:
    """Middle of the first ``lo-hi`` pair of numbers, truncated; NULL without one."""
    pattern = r"(\d+)\s*-\s*(\d+)"
    found = [F.regexp_extract(c, pattern, i) for i in (1, 2)]
    low, high = (F.when(text != "", text.try_cast("int").cast("long")) for text in found)
    return ((low + high) / 2).cast("int")


def is_one_of(c: Column, values: Sequence[str]) -> Column:
    return flag(c.isin(*values))


def readmission_target(c: Column) -> Column:
    """1 within 30 days, 0 later or never, NULL for any other text."""
    return F.when(c == "<30", 1).when(c.isin(">30", "NO"), 0)


def age_category(midpoint: Column) -> Column:
    return (
        F.when(midpoint < 30, "Under 30")
        .when(midpoint.between(30, 64), "30-64")
        .otherwise("65 and older")
    )


def stay_category(days: Column) -> Column:
    return (
        F.when(days.between(1, 2), "Short").when(days.between(3, 6), "Medium").otherwise("Long")
    )


def code_head(code: Column) -> Column:
    """The part of a diagnosis code before its first dot, as text."""
    return F.substring_index(code, ".", 1)


# Whole numbers that fit an int.
_NUMBER = r"^\s*[+-]?0*\d{1,9}\s*$"


def code_number(head: Column) -> Column:
    """That part as a number; NULL for letter codes."""
    return F.when(head.rlike(_NUMBER), head.cast("int"))


def in_group(head: Column, number: Column, group: str) -> Column:
    """Whether a code falls in the group's range or is its symptom code."""
    low, high, symptom = next((lo, hi, s) for g, lo, hi, s in DIAGNOSIS_RANGES if g == group)
    inside = number.between(low, high)
    return inside if symptom is None else inside | (head == symptom)


def is_diabetes_code(code: Column) -> Column:
    return code.startswith(DIABETES_PREFIX)


def diagnosis_group(code: Column, head: Column, number: Column) -> Column:
    """Group name of a code whose head and number are already computed."""
    blank = code.isNull() | F.trim(code).isin("", MISSING_TOKEN)
    named = F.when(blank, "Missing").when(is_diabetes_code(code), "Diabetes")
    for group, *_ in DIAGNOSIS_RANGES:
        named = named.when(in_group(head, number, group), group)
    return named.otherwise("Other")


def utilization_tier(visits: Column) -> Column:
    return (
        F.when(visits == 0, "None (0 visits)")
        .when(visits.between(1, 2), "Low (1-2 visits)")
        .when(visits.between(3, 5), "Moderate (3-5 visits)")
        .otherwise("High (6+ visits)")
    )


def inpatient_frequency_tier(stays: Column) -> Column:
    return F.when(stays == 0, "0 visits").when(stays == 1, "1 visit").otherwise("2+ visits")


# The source names the tiers but not where they start; these starts fit its samples.
RISK_TIER_STARTS = (("Critical", 0.80), ("High", 0.50), ("Moderate", 0.25))


def risk_tier(probability: Column, starts: Sequence[tuple[str, float]] = RISK_TIER_STARTS) -> Column:
    """Tier of a probability, from the highest start down; NULL stays NULL."""
    tier = F.when(probability.isNull(), F.lit(None).cast("string"))
    for name, start in sorted(starts, key=lambda s: -s[1]):
        tier = tier.when(probability >= F.lit(float(start)), name)
    return tier.otherwise("Low")
