"""Bundles in their free form: resources of any kind as VARIANT, text ids, and what is not usable.

``resources_of`` keeps every resource whole, whatever its fields, and fields are taken from it by
path and type. ``quarantine`` sorts bundles by why they cannot be read. ``number_keys`` gives
text ids lasting numbers, so that the tables behind can stay keyed by long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlight.operators.spread import join_spread
from wardlight.session import materialize, shuffle_width

REASONS = ("null", "not_json", "not_a_bundle", "no_entries", "no_resource", "encounter_without_id")
STEP = 2**33  # monotonically_increasing_id puts the partition above this


def _entries(parsed: Column) -> Column:
    return F.try_variant_get(parsed, "$.entry", "array<variant>")


def _text(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def reject_reason(column: str = "bundle") -> Column:
    """Why a bundle is not usable (one of REASONS, the first that fits), NULL where it is."""
    parsed = F.try_parse_json(column)
    entries = _entries(parsed)
    kind = lambda e: _text(e, "$.resource.resourceType")
    nameless = lambda e: (kind(e) == "Encounter") & _text(e, "$.resource.id").isNull()
    return (
        F.when(F.col(column).isNull(), "null")
        .when(parsed.isNull(), "not_json")
        .when(~_text(parsed, "$.resourceType").eqNullSafe("Bundle"), "not_a_bundle")
        .when(F.coalesce(F.size(entries), F.lit(0)) < 1, "no_entries")
        .when(F.exists(entries, lambda e: kind(e).isNull()), "no_resource")
        .when(F.coalesce(F.exists(entries, nameless), F.lit(False)), "encounter_without_id")
    )


def quarantine(bundles: DataFrame, column: str = "bundle") -> tuple[DataFrame, DataFrame]:
    """Usable bundles, and the others whole with their reason. Each text is parsed once, into a
    stored table that both sides are read from, each from its own folder."""
    judged = bundles.withColumn("reason", F.coalesce(reject_reason(column), F.lit("")))
    stored = materialize(judged, "judged-bundles")
    return stored.filter("reason = ''").drop("reason"), stored.filter("reason <> ''")


def resources_of(bundles: DataFrame, column: str = "bundle") -> DataFrame:
    """resource_type, resource_id and the resource itself as VARIANT, for every entry that has a
    kind; bundles that do not parse give no rows (``quarantine`` has them)."""
    entry = F.explode(_entries(F.try_parse_json(column))).alias("entry")
    resource = F.try_variant_get("entry", "$.resource", "variant").alias("resource")
    return (
        bundles.select(entry)
        .select(resource)
        .select(
            _text(F.col("resource"), "$.resourceType").alias("resource_type"),
            _text(F.col("resource"), "$.id").alias("resource_id"),
            "resource",
        )
        .filter("resource_type IS NOT NULL")
    )


def fields_of(resources: DataFrame, kind: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """resource_id and the named fields (path, type) of one kind; NULL where absent or of
    another type."""
    return resources.filter(F.col("resource_type") == kind).select(
        "resource_id", *[F.try_variant_get("resource", path, t).alias(c) for c, (path, t) in fields.items()]
    )


def number_keys(keys: DataFrame, column: str, stored: DataFrame | None = None) -> DataFrame:
    """A table ``key string, number long`` of every distinct key, numbered from 1 in the order of
    the keys; with ``stored``, its keys keep their numbers and new ones follow its largest.

    Keys are sorted by ranges and numbered within them, so no task holds them all; what each
    range is moved by is one number, and there are as many as shuffle partitions. NULL is no key.
    """
    spark = keys.sparkSession
    found = keys.select(F.col(column).cast("string").alias("key")).filter("key IS NOT NULL").distinct()
    if stored is not None:
        found = found.join(stored.select("key"), "key", "left_anti")
    placed = materialize(
        found.repartitionByRange(shuffle_width(spark), "key")
        .sortWithinPartitions("key")
        .select("key", F.monotonically_increasing_id().alias("place")),
        "keys",
    )
    part = F.floor(F.col("place") / STEP).alias("part")
    sizes = placed.groupBy(part).count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    moves = F.broadcast(sizes.select("part", before.alias("moved")))
    start = (stored.agg(F.max("number")).first()[0] or 0) if stored is not None else 0
    fresh = placed.withColumn("part", part).join(moves, "part").select(
        "key", (F.pmod("place", F.lit(STEP)) + F.col("moved") + 1 + F.lit(start)).cast("long").alias("number")
    )
    return fresh if stored is None else stored.select("key", "number").unionByName(fresh)


def with_numbers(rows: DataFrame, column: str, numbers: DataFrame, as_: str) -> DataFrame:
    """The rows with the number of their text id as another column; a key that very many rows
    share does not make one task large, an unknown or NULL one has NULL. Give ``rows`` as a stored
    table: they are read to be counted and to be joined."""
    known = numbers.select(F.col("key").alias(column), F.col("number").alias(as_))
    given, none = rows.filter(F.col(column).isNotNull()), rows.filter(F.col(column).isNull())
    met = join_spread(given, known, [column], many_keys=True)
    return met.select(*rows.columns, as_).unionByName(none.select("*", F.lit(None).cast("long").alias(as_)))
