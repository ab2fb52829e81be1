"""Category indexes kept as a table, for columns of any number of values.

The same numbers as a string indexer's: by falling frequency, ties by name, one more for what
was not seen. Counting, ranking and looking up are Spark jobs; no label passes through the
driver, only each column's number of labels does.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.operators.ordered import number_rows
from wardlight.operators.spread import join_spread
from wardlight.session import materialize

ROW = "_row"


@dataclass(frozen=True)
class CategoryTable:
    """``labels``: feature, value, index and rows; ``sizes``: the number of labels by column."""

    labels: DataFrame
    sizes: dict[str, int]

    def save(self, path: str) -> None:
        self.labels.write.mode("overwrite").parquet(path)


def _long(df: DataFrame, columns: Sequence[str], *carry: str) -> DataFrame:
    """One row for each value: feature and value as text."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return df.select(*carry, F.explode(pairs).alias("_pair")).select(*carry, "_pair.*")


def fit_categories(df: DataFrame, columns: Sequence[str]) -> CategoryTable:
    """Rank the values of every column in one pass, one aggregation and one sort."""
    counts = (
        _long(df, columns)
        .filter(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    numbered = number_rows(counts, ["feature", F.col("rows").desc(), "value"], "_at")
    first = numbered.groupBy("feature").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("labels"))
    first = materialize(first, "category-sizes")
    # A row for each column: never more than the columns asked for.
    labels = numbered.join(F.broadcast(first), "feature").select(
        "feature", "value", (F.col("_at") - F.col("_first")).alias("index"), "rows"
    )
    found = {r["feature"]: r["labels"] for r in first.collect()}
    return CategoryTable(materialize(labels, "categories"), {c: found.get(c, 0) for c in columns})


def load_categories(spark: SparkSession, path: str, columns: Sequence[str]) -> CategoryTable:
    labels = spark.read.parquet(path)
    found = {r["feature"]: r["labels"] for r in labels.groupBy("feature").agg(F.count(F.lit(1)).alias("labels")).collect()}
    return CategoryTable(labels, {c: found.get(c, 0) for c in columns})


def index_categories(df: DataFrame, table: CategoryTable) -> DataFrame:
    """``df`` with ``{c}_indexed`` for every column of the table.

    Values meet the table as rows of (row, feature, value), so the columns share one join;
    values that very many rows have are met where they are. Columns know their number of
    values from metadata, as an encoder expects.
    """
    columns = list(table.sizes)
    rows = materialize(df.withColumn(ROW, F.monotonically_increasing_id()), "rows-to-index")
    values = _long(rows, columns, ROW)
    unique = table.labels.select("feature", "value", "index")
    found = join_spread(values, unique, ["feature", "value"])
    wide = found.groupBy(ROW).agg(
        *[F.max(F.when(F.col("feature") == c, F.col("index"))).alias(f"_at_{c}") for c in columns]
    )
    joined = rows.join(wide, ROW)
    indexed = [
        F.coalesce(F.col(f"_at_{c}"), F.lit(table.sizes[c])).cast("double").alias(
            f"{c}_indexed", metadata={"ml_attr": {"type": "nominal", "num_vals": table.sizes[c] + 1}}
        )
        for c in columns
    ]
    return joined.select(*df.columns, *indexed)


def category_vectors(df: DataFrame, table: CategoryTable, numerical: Sequence[str] = (), to: str = "features") -> DataFrame:
    """``df`` with one sparse vector: a block of labels + 2 slots for each column, then numbers.

    Slots are those of the usual pipeline before scaling: labels, the one of values not seen,
    and the encoder's own.
    """
    columns = list(table.sizes)
    indexed = index_categories(df, table)
    encoder = OneHotEncoder(
        inputCols=[f"{c}_indexed" for c in columns], outputCols=[f"{c}_vec" for c in columns],
        handleInvalid="keep", dropLast=False,
    )
    # Sizes come from the columns' metadata, so this fit reads no rows.
    encoded = encoder.fit(indexed).transform(indexed)
    assembled = VectorAssembler(
        inputCols=[*[f"{c}_vec" for c in columns], *numerical], outputCol=to, handleInvalid="keep"
    ).transform(encoded)
    return assembled.select(*df.columns, to)
