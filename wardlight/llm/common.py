"""What the operators share: row ids, packed rows between stages, stored steps."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.session import materialize, shuffle_width

#: White space that ends a word: blank, tab, \n, \v, \f, \r. bytes.split() cuts at the same six.
BLANKS = " \t\n\x0b\x0c\r"

__all__ = ["BLANKS", "materialize", "mix64", "one_of", "rows_of", "shuffle_width", "table", "texts_of", "worker_kept"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame, *columns: str, text: str = "text", row: str | None = None) -> DataFrame:
    """The named columns and the text, null as empty; with ``row``, a number for each row.

    Only these columns are read, so others with any name do no harm. The number tells rows
    apart whose ids repeat or are null; it depends on the scan's splits alone, which are the
    same whenever a lost task is run again.
    """
    chosen = [F.col(c) for c in columns] + [F.coalesce(F.col(text), F.lit("")).alias("text")]
    if row:
        chosen.insert(0, F.monotonically_increasing_id().alias(row))
    return docs.select(*chosen)


def one_of(value, batch: pa.RecordBatch) -> list:
    return batch.column(batch.schema.get_field_index(value)).to_pylist()


def rows_of(schema: pa.Schema, rows: Iterable[tuple], size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema
            )
            held = []
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema
        )


def worker_kept(name: Hashable, make: Callable):
    """What ``make`` gives, made once in a worker process and found again by its later tasks.

    Only for what depends on nothing but its name, such as a loaded vocabulary: functions
    come to a worker by value, so their own modules are not kept from task to task.
    """
    module = sys.modules.setdefault("wardlight_worker_state", types.ModuleType("wardlight_worker_state"))
    if name not in module.__dict__:
        module.__dict__[name] = make()
    return module.__dict__[name]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
