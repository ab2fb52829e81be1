"""Row filters and token cleaning of raw encounters. No shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight.functions import clinical as fn


def _as_int(df: DataFrame, column: str):
    """The column as int; a column that is one already stays bare so filters push down."""
    c = F.col(column)
    return c if isinstance(df.schema[column].dataType, T.IntegerType) else c.try_cast("int")


def drop_terminal_discharges(
    df: DataFrame,
    column: str = "discharge_disposition_id",
    ids: Sequence[int] = fn.TERMINAL_DISCHARGE_IDS,
) -> DataFrame:
    """Drop deaths and hospice discharges; an unknown disposition is dropped too."""
    return df.filter(~_as_int(df, column).isin(*ids))


def drop_invalid_genders(
    df: DataFrame, column: str = "gender", invalid: Sequence[str] = fn.INVALID_GENDERS
) -> DataFrame:
    c = F.col(column)
    return df.filter(c.isNotNull() & ~c.isin(*invalid))


def replace_missing_tokens(
    df: DataFrame, token: str = fn.MISSING_TOKEN, columns: Sequence[str] | None = None
) -> DataFrame:
    """Turn the missing marker into NULL in the given (default: all) text columns."""
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    wanted = text if columns is None else set(columns)
    return df.select(
        [
            fn.missing_to_null(F.col(c), token).alias(c) if c in wanted else F.col(c)
            for c in df.columns
        ]
    )


def clean_encounters(
    df: DataFrame,
    token: str = fn.MISSING_TOKEN,
    terminal_ids: Sequence[int] = fn.TERMINAL_DISCHARGE_IDS,
    invalid_genders: Sequence[str] = fn.INVALID_GENDERS,
) -> DataFrame:
    """Filters first, tokens last: a gender given as the marker survives as NULL."""
    return (
        df.transform(drop_terminal_discharges, ids=terminal_ids)
        .transform(drop_invalid_genders, invalid=invalid_genders)
        .transform(replace_missing_tokens, token=token)
    )
