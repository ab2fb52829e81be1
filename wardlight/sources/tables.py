"""Catalog tables over stored encounters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardlight import schema as S


def create_clean_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """External table of the 55 clean columns over Parquet files already written."""
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})
    return spark.catalog.createTable(name, path=path, source="parquet", schema=S.CLEAN_SCHEMA)


def write_clean_table(df: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """Write encounters bucketed and sorted by id; joins on the id then need no shuffle."""
    (
        df.repartition(buckets, "encounter_id")
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, "encounter_id")
        .sortBy("encounter_id")
        .option("path", path)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)
