"""Integrity checks.

Schema checks read names only. Data checks are DataFrames built from one
aggregation whose partial results are combined before the shuffle; ``enforce``
reads the one-row report and raises.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from wardlight import schema as S
from wardlight.errors import DataIntegrityError, FeatureValidationError, SchemaValidationError
from wardlight.functions import clinical as fn


def _missing(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    present = {S.normalize_name(c) for c in df.columns}
    return [c for c in wanted if S.normalize_name(c) not in present]


def require_columns(df: DataFrame, wanted: Sequence[str]) -> None:
    """Raise when a column is absent, comparing normalized names."""
    missing = _missing(df, wanted)
    if missing:
        raise SchemaValidationError(f"missing columns: {missing}")


def validate_input_columns(df: DataFrame, expected: Sequence[str] = tuple(S.RAW_COLUMNS)) -> None:
    require_columns(df, expected)


def validate_output_columns(df: DataFrame, required: Sequence[str] = tuple(S.CLEAN_COLUMNS)) -> None:
    require_columns(df, required)


def validate_feature_columns(
    given: DataFrame | list | tuple | set,
    require_target: bool = True,
    inputs: Sequence[str] = tuple(S.FEATURE_COLUMNS),
) -> None:
    """Raise unless every model input is there by its exact name and none of ``inputs``, the
    columns a model is to be trained on, gives the answer away."""
    if isinstance(given, DataFrame):
        names = set(given.columns)
    elif isinstance(given, (list, tuple, set)):
        names = set(given)
    else:
        raise TypeError(f"need a DataFrame or names, got {type(given).__name__}")
    needed = [("categorical", S.CATEGORICAL_FEATURES), ("numerical", S.NUMERICAL_FEATURES)]
    if require_target:
        needed.append(("target", [S.TARGET_COLUMN]))
    for kind, columns in needed:
        missing = [c for c in columns if c not in names]
        if missing:
            raise FeatureValidationError(f"missing {kind} columns: {missing}")
    leaked = {c for c in inputs if c in S.EXCLUDED_COLUMNS or c == S.TARGET_COLUMN}
    if leaked:
        raise FeatureValidationError(f"excluded columns used as features: {sorted(leaked)}")


def duplicate_keys(df: DataFrame, key: str = "encounter_id") -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def require_unique(df: DataFrame, key: str = "encounter_id") -> None:
    """Raise when a key repeats, before a join on it multiplies rows. One aggregation."""
    if duplicate_keys(df, key).limit(1).count():
        raise DataIntegrityError(f"{key} repeats; a join on it would multiply rows")


def target_distribution(df: DataFrame, column: str = S.TARGET_COLUMN) -> DataFrame:
    require_columns(df, [column])
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def flag_distributions(df: DataFrame, columns: Sequence[str] = tuple(S.FLAG_COLUMNS)) -> DataFrame:
    """Counts per flag and value for all flags in one pass."""
    require_columns(df, columns)
    long = df.select(*columns).unpivot([], list(columns), "flag", "value")
    return long.groupBy("flag", "value").agg(F.count(F.lit(1)).alias("rows"))


def age_statistics(
    df: DataFrame, column: str = "age_midpoint", low: int = 0, high: int = 120
) -> DataFrame:
    """One row: range, count, and how many ages are unknown or out of range."""
    require_columns(df, [column])
    c = F.col(column)
    return df.agg(
        F.min(c).alias("min_age"),
        F.max(c).alias("max_age"),
        F.count(c).alias("total_records"),
        F.count_if(c.isNull()).alias("null_ages"),
        F.count_if(~c.between(low, high)).alias("out_of_range_ages"),
    )


def terminal_discharge_count(
    df: DataFrame,
    column: str = "discharge_disposition_id",
    ids: Sequence[int] = fn.TERMINAL_DISCHARGE_IDS,
) -> DataFrame:
    """One row with the number of forbidden discharges; an absent column raises."""
    require_columns(df, [column])
    remaining = F.col(column).try_cast("int").isin(*ids)
    return df.agg(F.count_if(remaining).alias("terminal_rows"))


def _rules(low_age: int, high_age: int) -> dict[str, Column]:
    """Name of each rule and the rows that break it."""
    age, target = F.col("age_midpoint"), F.col(S.TARGET_COLUMN)
    rules = {
        "terminal_rows": F.col("discharge_disposition_id").try_cast("int").isin(
            *fn.TERMINAL_DISCHARGE_IDS
        ),
        "bad_targets": target.isNull() | ~target.isin(0, 1),
        "null_ages": age.isNull(),
        "out_of_range_ages": ~age.between(low_age, high_age),
    }
    for c in S.FLAG_COLUMNS:
        rules[f"bad_{c}"] = F.col(c).isNull() | ~F.col(c).isin(0, 1)
    return rules


def clean_report(
    df: DataFrame,
    expected_input_count: int | None = None,
    low_age: int = 0,
    high_age: int = 120,
) -> DataFrame:
    """The whole integrity report as one row from one aggregation."""
    validate_output_columns(df)
    rules = _rules(low_age, high_age)
    counted = df.agg(
        F.count(F.lit(1)).alias("output_row_count"),
        *[
            F.count_if(F.col(c) == v).alias(f"{c}_{v}")
            for c in [S.TARGET_COLUMN, *S.FLAG_COLUMNS]
            for v in (0, 1)
        ],
        F.min("age_midpoint").alias("min_age"),
        F.max("age_midpoint").alias("max_age"),
        *[F.count_if(broken).alias(name) for name, broken in rules.items()],
    )
    given = F.lit(expected_input_count).cast("long")
    broken = sum((F.col(name) for name in rules), F.lit(0))
    return counted.select(
        F.when(broken == 0, "PASSED").otherwise("FAILED").alias("status"),
        "output_row_count",
        given.alias("input_row_count"),
        (given - F.col("output_row_count")).alias("rows_removed"),
        *[c for c in counted.columns if c != "output_row_count"],
        F.lit(len(df.columns)).alias("total_columns"),
    )


def enforce(report: DataFrame) -> Row:
    """Read a one-row report; raise with the broken rules unless it passed."""
    row = report.first()
    if row["status"] != "PASSED":
        broken = {name: row[name] for name in _rules(0, 120) if row[name]}
        raise DataIntegrityError(f"clean data breaks its rules: {broken}")
    return row


def _distribution(counts: DataFrame, column: str) -> dict[int, int]:
    """Counts per value as a mapping; raise on NULL or on anything but 0 and 1.

    The rows are summed up to at most four groups before the driver sees them.
    """
    kind = F.when(F.col(column).isin(0, 1), F.col(column).cast("string")).when(
        F.col(column).isNull(), "NULL"
    ).otherwise("other")
    found = {
        r["kind"]: r["rows"]
        for r in counts.groupBy(kind.alias("kind")).agg(F.sum("rows").alias("rows")).collect()
    }
    for bad in ("NULL", "other"):
        if bad in found:
            raise DataIntegrityError(f"{column}: {found[bad]} rows hold {bad} values")
    return {int(k): v for k, v in found.items()}


def validate_target_values(df: DataFrame, column: str = S.TARGET_COLUMN) -> dict[int, int]:
    return _distribution(target_distribution(df, column), column)


def validate_age_range(
    df: DataFrame, column: str = "age_midpoint", low: int = 0, high: int = 120
) -> dict[str, int | None]:
    """Raise on unknown or out-of-range ages; an empty frame has no range."""
    row = age_statistics(df, column, low, high).first()
    if row["null_ages"]:
        raise DataIntegrityError(f"{column}: {row['null_ages']} NULL values")
    if row["out_of_range_ages"]:
        raise DataIntegrityError(
            f"{column}: {row['out_of_range_ages']} values outside [{low}, {high}]"
        )
    return {c: row[c] for c in ("min_age", "max_age", "total_records")}


def validate_binary_flags(
    df: DataFrame, columns: Sequence[str] = tuple(S.FLAG_COLUMNS)
) -> dict[str, dict[int, int]]:
    """Distribution of every flag; raise on NULL or on anything but 0 and 1. One job."""
    require_columns(df, columns)
    row = df.agg(
        *[
            F.count_if(condition).alias(f"{c}:{name}")
            for c in columns
            for name, condition in (
                ("0", F.col(c) == 0),
                ("1", F.col(c) == 1),
                ("bad", F.col(c).isNull() | ~F.col(c).isin(0, 1)),
            )
        ]
    ).first()
    bad = {c: row[f"{c}:bad"] for c in columns if row[f"{c}:bad"]}
    if bad:
        raise DataIntegrityError(f"flags with NULL or non-binary values: {bad}")
    return {c: {v: row[f"{c}:{v}"] for v in (0, 1) if row[f"{c}:{v}"]} for c in columns}


def validate_no_terminal_discharges(df: DataFrame, column: str = "discharge_disposition_id") -> None:
    rows = terminal_discharge_count(df, column).first()["terminal_rows"]
    if rows:
        raise DataIntegrityError(f"{rows} terminal discharges remain")


def validate_cleaned_encounters(df: DataFrame, expected_input_count: int | None = None) -> Row:
    """Report of clean data as one row; raise if any rule is broken."""
    return enforce(clean_report(df, expected_input_count))
