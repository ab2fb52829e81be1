import json

import pytest
from pyspark.sql import functions as F

from wardlight.session import materialize
from wardlight.sources import bundles, free_bundles


def bundle(*resources):
    return json.dumps({"resourceType": "Bundle", "entry": [{"resource": r} for r in resources]})


ENCOUNTER = {"resourceType": "Encounter", "id": "ENC1", "subject": {"reference": "Patient/PAT9"}}
TEXTS = {
    "good": (bundle(ENCOUNTER), None),
    "free": (bundle({"resourceType": "Observation", "id": "o", "value": {"deep": [1, 2.5]}}), None),
    "null": (None, "null"),
    "torn": (bundle(ENCOUNTER)[:-2], "not_json"),
    "blank": ("", "not_json"),
    "list": ('{"resourceType":"List","entry":[{}]}', "not_a_bundle"),
    "array": ("[1]", "not_a_bundle"),
    "number": ("7", "not_a_bundle"),
    "bare": ('{"resourceType":"Bundle"}', "no_entries"),
    "empty": ('{"resourceType":"Bundle","entry":[]}', "no_entries"),
    "text": ('{"resourceType":"Bundle","entry":"x"}', "no_entries"),
    "hollow": ('{"resourceType":"Bundle","entry":[{"resource":null}]}', "no_resource"),
    "nulls": ('{"resourceType":"Bundle","entry":[null]}', "no_resource"),
    "nameless": (bundle({"resourceType": "Encounter"}), "encounter_without_id"),
}


@pytest.fixture(scope="module")
def given(spark):
    return spark.createDataFrame([(n, t) for n, (t, _) in TEXTS.items()], "name string, bundle string")


def test_every_reason(spark, given):
    usable, aside = free_bundles.quarantine(given)
    assert {r["name"] for r in usable.collect()} == {"good", "free"} and usable.columns == given.columns
    assert {r["name"]: r["reason"] for r in aside.collect()} == {n: why for n, (_, why) in TEXTS.items() if why}
    assert {why for _, why in TEXTS.values() if why} == set(free_bundles.REASONS)
    assert {r["name"]: r["bundle"] for r in aside.collect()} == {n: t for n, (t, why) in TEXTS.items() if why}


def test_resources_keep_all_fields(spark, given):
    found = free_bundles.resources_of(given.filter("name IN ('good', 'free', 'torn')"))
    assert {(r["resource_type"], r["resource_id"]) for r in found.collect()} == {("Encounter", "ENC1"), ("Observation", "o")}
    fields = {"first": ("$.value.deep[0]", "int"), "wrong": ("$.value", "int"), "absent": ("$.nothing", "string")}
    row, = free_bundles.fields_of(found, "Observation", fields).collect()
    assert (row["resource_id"], row["first"], row["wrong"], row["absent"]) == ("o", 1, None, None)


def test_keys_are_numbered_once_and_for_good(spark):
    first = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("",)], "id string")
    stored = materialize(free_bundles.number_keys(first, "id"), "numbers")
    assert {r["key"]: r["number"] for r in stored.collect()} == {"": 1, "a": 2, "b": 3}
    later = spark.createDataFrame([("a",), ("A",), ("c",)], "id string")
    assert {r["key"]: r["number"] for r in free_bundles.number_keys(later, "id", stored).collect()} == {
        "": 1, "a": 2, "b": 3, "A": 4, "c": 5,
    }
    assert free_bundles.number_keys(first.limit(0), "id").count() == 0


def test_numbers_are_dense_over_many_ranges(spark):
    keys = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("id"))
    numbers = free_bundles.number_keys(keys, "id").orderBy("key").collect()
    assert [r["number"] for r in numbers] == list(range(1, 20_001))


def test_a_hot_key_and_unknown_ones(spark):
    rows = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), "id")).alias("id")
    )
    numbers = free_bundles.number_keys(rows.filter("id <> 'k1'"), "id")
    met = free_bundles.with_numbers(rows, "id", numbers, "number")
    assert met.count() == 3_000 and met.columns == ["id", "number"]
    assert met.filter("number IS NULL").count() == 1_001
    assert met.filter("id = 'hot'").select("number").distinct().count() == 1


def test_text_ids_flatten(spark):
    condition = {
        "resourceType": "Condition", "id": "c/1".replace("/", "-"),
        "code": {"coding": [{"system": "own", "code": "x"}, {"system": bundles.ICD9, "code": "250.1"}]},
    }
    encounter = ENCOUNTER | {"diagnosis": [{"condition": {"reference": "Condition/c-1"}, "rank": r} for r in (1, 5)]}
    rows = spark.createDataFrame([(bundle(encounter),), (bundle(condition),)], "bundle string")
    flat, = bundles.flatten_bundles(rows, id_type="string").collect()
    assert (flat["encounter_id"], flat["patient_nbr"], flat["diag_1"], flat["diag_2"]) == ("ENC1", "PAT9", "250.1", None)
    listed = bundles.flatten_diagnoses(rows, id_type="string").collect()
    assert sorted((r["encounter_id"], r["rank"], r["code"]) for r in listed) == [
        ("ENC1", 1, "250.1"), ("ENC1", 1, "x"), ("ENC1", 5, "250.1"), ("ENC1", 5, "x"),
    ]
