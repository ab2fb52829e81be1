"""FHIR-style JSON bundles of Encounter and Condition resources.

An Encounter lists its diagnoses as ranked references to Conditions, which may
stand in another bundle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.operators.spread import join_spread
from wardlight.session import materialize

RESOURCE = (
    "struct<resourceType: string, id: string, subject: struct<reference: string>,"
    " length: struct<value: int, unit: string>,"
    " diagnosis: array<struct<condition: struct<reference: string>, rank: int>>,"
    " code: struct<coding: array<struct<system: string, code: string>>>>"
)
BUNDLE_SCHEMA = f"resourceType string, entry array<struct<resource: {RESOURCE}>>"
ICD9 = "http://hl7.org/fhir/sid/icd-9-cm"
RANKS = {1: "diag_1", 2: "diag_2", 3: "diag_3"}


def _reference(kind: str, key: Column) -> Column:
    return F.struct(F.concat(F.lit(f"{kind}/"), key).alias("reference"))


def _key(reference: Column) -> Column:
    """The id a ``Kind/id`` reference points to."""
    return F.split_part(reference, F.lit("/"), F.lit(2))


def encounters_to_bundles(
    encounters: DataFrame,
    ranks: Mapping[int, str] = RANKS,
    codings: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """One bundle per encounter: the Encounter and a Condition per known diagnosis.

    ``ranks`` gives the columns of diagnoses by rank, ``codings`` what each system makes of a
    code, in the order of the Condition's codings (default: the code itself, as ICD-9). Ids may
    be numbers or text.
    """
    codings = codings or {ICD9: lambda code: code}
    key = F.col("encounter_id").cast("string")
    ranked = F.filter(
        F.array(
            *[F.struct(F.lit(r).alias("rank"), F.col(c).alias("code")) for r, c in ranks.items()]
        ),
        lambda d: d["code"].isNotNull(),
    )

    def condition_id(d: Column) -> Column:
        return F.concat(key, F.lit("-"), d["rank"].cast("string"))

    # Both kinds go through one struct type so that they can share the entry array.
    encounter = F.struct(
        F.lit("Encounter").alias("resourceType"),
        key.alias("id"),
        _reference("Patient", F.col("patient_nbr").cast("string")).alias("subject"),
        F.struct(F.col("time_in_hospital").alias("value"), F.lit("d").alias("unit")).alias(
            "length"
        ),
        F.transform(
            F.col("_ranked"),
            lambda d: F.struct(
                _reference("Condition", condition_id(d)).alias("condition"),
                d["rank"].alias("rank"),
            ),
        ).alias("diagnosis"),
        F.lit(None).alias("code"),
    ).cast(RESOURCE)
    conditions = F.transform(
        F.col("_ranked"),
        lambda d: F.struct(
            F.lit("Condition").alias("resourceType"),
            condition_id(d).alias("id"),
            F.lit(None).alias("subject"),
            F.lit(None).alias("length"),
            F.lit(None).alias("diagnosis"),
            F.struct(
                F.array(
                    *[F.struct(F.lit(s).alias("system"), make(d["code"]).alias("code")) for s, make in codings.items()]
                ).alias("coding")
            ).alias("code"),
        ).cast(RESOURCE),
    )
    entries = F.transform(
        F.concat(F.array(encounter), conditions), lambda r: F.struct(r.alias("resource"))
    )
    return encounters.withColumn("_ranked", ranked).select(
        F.to_json(
            F.struct(F.lit("Bundle").alias("resourceType"), entries.alias("entry"))
        ).alias("bundle")
    )


def resources(bundles: DataFrame, column: str = "bundle") -> DataFrame:
    """One row per resource of every bundle."""
    return bundles.select(
        F.explode(F.from_json(column, BUNDLE_SCHEMA)["entry"]).alias("entry")
    ).select("entry.resource.*")


def _coding(codings: Column) -> Column:
    """The coding a column of codes takes: the first in ICD-9, else the first of all."""
    own = F.filter(codings, lambda c: c["system"] == ICD9)
    return F.coalesce(F.get(own, F.lit(0)), F.get(codings, F.lit(0)))


def bundle_report(bundles: DataFrame, column: str = "bundle") -> DataFrame:
    """One row: n_bundles, n_null, n_unparsed (text that is not JSON of the schema, whole or in
    part) and n_without_entries (parsed, but nothing in it), so that what gives no rows is known."""
    read = F.from_json(
        column, f"{BUNDLE_SCHEMA}, _unparsed string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unparsed"}
    )
    given, broken = F.col(column).isNotNull(), F.col("_read._unparsed").isNotNull()
    bare = F.coalesce(F.size("_read.entry"), F.lit(0)) < 1
    return bundles.select(column, read.alias("_read")).agg(
        F.count(F.lit(1)).alias("n_bundles"),
        F.count_if(~given).alias("n_null"),
        F.count_if(given & broken).alias("n_unparsed"),
        F.count_if(given & ~broken & bare).alias("n_without_entries"),
    )


def flatten_diagnoses(bundles: DataFrame, column: str = "bundle", id_type: str = "long") -> DataFrame:
    """Every diagnosis an encounter lists, whatever its rank: encounter_id, rank, condition_id, and
    each distinct system and code of the Condition and its copies; NULL where no Condition came.
    Text ids take ``id_type`` "string"."""
    found = materialize(
        resources(bundles, column).filter(F.col("resourceType").isin("Encounter", "Condition")), "resources"
    )
    listed = materialize(
        found.filter(F.col("resourceType") == "Encounter")
        .select(F.col("id").cast(id_type).alias("encounter_id"), F.explode("diagnosis").alias("listed"))
        .select("encounter_id", "listed.rank", _key(F.col("listed.condition.reference")).alias("condition_id"))
        .distinct(),
        "all-diagnoses",
    )
    codings = (
        found.filter(F.col("resourceType") == "Condition")
        .select(F.col("id").alias("condition_id"), F.explode("code.coding").alias("coding"))
        .groupBy("condition_id")
        .agg(F.array_sort(F.collect_set("coding")).alias("codings"))
    )
    return join_spread(listed, codings, ["condition_id"], many_keys=True).select(
        "encounter_id", "rank", "condition_id", F.explode_outer("codings").alias("coding")
    ).select("encounter_id", "rank", "condition_id", "coding.system", "coding.code")


def flatten_bundles(bundles: DataFrame, column: str = "bundle", id_type: str = "long") -> DataFrame:
    """Encounter rows with the codes of their diagnoses of rank 1 to 3; ``flatten_diagnoses`` has
    all ranks and codings, ``bundle_report`` counts what gives no rows. Text ids take ``id_type`` "string".

    A diagnosis reference meets its Condition by id; codes are then spread to
    columns by a conditional aggregate that is combined before it is shuffled. The
    JSON is parsed once, into a stored table both kinds of resource are read from.
    """
    found = materialize(
        resources(bundles, column).filter(F.col("resourceType").isin("Encounter", "Condition")),
        "resources",
    )
    scalars = ["encounter_id", "patient_nbr", "time_in_hospital"]
    encounters = found.filter(F.col("resourceType") == "Encounter").select(
        F.col("id").cast(id_type).alias("encounter_id"),
        _key(F.col("subject.reference")).cast(id_type).alias("patient_nbr"),
        F.col("length.value").alias("time_in_hospital"),
        F.explode_outer("diagnosis").alias("listed"),
    )
    # An encounter without diagnoses gets a key of its own that no condition has:
    # NULL keys would all meet in one task.
    none = F.concat(F.lit("none for "), F.col("encounter_id").cast("string"))
    ranked = encounters.select(
        *scalars,
        F.col("listed.rank").alias("rank"),
        F.coalesce(_key(F.col("listed.condition.reference")), none).alias("condition_id"),
    )
    # Copies of a condition, however many were sent, collapse before the join; the
    # join then keeps the aggregate's partitioning.
    coding = _coding(F.col("code.coding"))
    conditions = (
        found.filter(F.col("resourceType") == "Condition")
        .groupBy(F.col("id").alias("condition_id"))
        .agg(F.max(F.struct(coding["system"].eqNullSafe(ICD9).alias("own"), coding["code"].alias("code")))["code"].alias("code"))
    )
    # A condition that very many encounters name is joined apart from the shuffle. Copies of an
    # encounter need no step of their own: they collapse in the last aggregate.
    return (
        join_spread(ranked, conditions, ["condition_id"], many_keys=True)
        .groupBy(*scalars)
        .agg(*[F.max(F.when(F.col("rank") == r, F.col("code"))).alias(c) for r, c in RANKS.items()])
    )


def flatten_conditions(bundles: DataFrame, column: str = "bundle") -> DataFrame:
    """Condition rows: their id and the coding chosen by system, then by place."""
    coding = _coding(F.col("code.coding"))
    return resources(bundles, column).filter(F.col("resourceType") == "Condition").select(
        F.col("id").alias("condition_id"),
        coding["system"].alias("system"),
        coding["code"].alias("code"),
    )


def read_properties(events: DataFrame, schema: str, column: str = "props") -> DataFrame:
    """Columns of a JSON object column beside the event's own columns."""
    parsed = events.withColumn("_parsed", F.from_json(column, schema))
    return parsed.select(*[c for c in events.columns if c != column], "_parsed.*")
