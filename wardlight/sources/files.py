"""Raw delimited files in, Parquet out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight import schema as S

CORRUPT = "_corrupt_record"


def header_names(spark: SparkSession, path: str) -> list[str]:
    """The names in the first line of the files."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def read_raw_csv(
    spark: SparkSession, path: str | list[str], keep_corrupt: bool = False, names: list[str] | None = None
) -> DataFrame:
    """Raw encounters under their header's names, typed, without an inference pass.

    The header is compared with the schema and a different one fails the read. ``names``
    are the columns in the order of the file, where that is known to be another.
    Lines that do not parse keep what does; ``keep_corrupt`` adds their text.
    """
    schema = S.RAW_SCHEMA
    if names is not None:
        kinds = {S.normalize_name(f.name): f.dataType for f in S.RAW_SCHEMA}
        schema = T.StructType([T.StructField(n, kinds.get(S.normalize_name(n), T.StringType())) for n in names])
    if keep_corrupt:
        schema = T.StructType([*schema, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def read_raw_positional(spark: SparkSession, path: str) -> DataFrame:
    """The same file by column position: the header line is skipped, not read."""
    return (
        spark.read.schema(S.ENCOUNTER_SCHEMA)
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Text fields keep their blanks, so a read returns what was written."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def land_raw(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Land a raw CSV as Parquet and report what arrived, as one row.

    The counts come from the landed columns, not from a second parse of the text,
    and the text of lines that did not parse stays in the landed table.
    """
    read_raw_csv(spark, source, keep_corrupt=True).transform(S.normalize_columns).write.mode(
        "overwrite"
    ).parquet(target)
    return spark.read.parquet(target).agg(
        F.count(F.lit(1)).alias("landed_rows"),
        F.count(F.col(CORRUPT)).alias("corrupt_rows"),
    )


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.CLEAN_SCHEMA).parquet(path)


def write_report_csv(report: DataFrame, path: str) -> None:
    """A comparison report (one row per model) as one CSV file with a header."""
    report.coalesce(1).write.mode("overwrite").option("header", True).option(
        "nullValue", ""
    ).csv(path)
