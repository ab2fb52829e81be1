import re

import pytest
from pyspark.sql import functions as F

from wardlight import schema as S
from wardlight.errors import DataIntegrityError
from wardlight.operators import lookups, views
from wardlight.session import scratch_path
from wardlight.sources.tables import write_clean_table


def encounters(spark, **columns):
    """Rows of clean encounters that are NULL but for the columns given."""
    n = len(next(iter(columns.values())))
    rows = [
        tuple(columns[f.name][i] if f.name in columns else None for f in S.CLEAN_SCHEMA)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, S.CLEAN_SCHEMA)


def test_age_bins(spark):
    ages = [None, 5, 29, 30, 64, 65, 74, 75]
    got = views.age_bins(encounters(spark, encounter_id=list(range(8)), age_midpoint=ages))
    assert [(r["age_category"], r["is_senior"], r["is_geriatric"]) for r in got.collect()] == [
        ("65 and older", 0, 0), ("Under 30", 0, 0), ("Under 30", 0, 0), ("30-64", 0, 0),
        ("30-64", 0, 0), ("65 and older", 1, 0), ("65 and older", 1, 0), ("65 and older", 1, 1),
    ]


def test_stay_categories(spark):
    days = [None, -1, 0, 1, 2, 3, 6, 7]
    got = views.stay_categories(encounters(spark, time_in_hospital=days)).collect()
    assert [(r["stay_category"], r["is_long_stay"], r["is_short_stay"]) for r in got] == [
        ("Long", 0, 0), ("Long", 0, 1), ("Long", 0, 1), ("Short", 0, 1), ("Short", 0, 1),
        ("Medium", 0, 0), ("Medium", 0, 0), ("Long", 1, 0),
    ]


CODES = {
    None: "Missing", "": "Missing", " ? ": "Missing", "250": "Diabetes", "250.83": "Diabetes",
    "2501": "Diabetes", "390": "Circulatory", "459.9": "Circulatory", "785.5": "Circulatory",
    "460": "Respiratory", "786": "Respiratory", "579": "Digestive", "787.1": "Digestive",
    "580": "Genitourinary", "788": "Genitourinary", "710": "Musculoskeletal", "739.9": "Musculoskeletal",
    "140": "Neoplasms", "239": "Neoplasms", "800": "Injury", "999": "Injury",
    "V57": "Other", "E909": "Other", "240": "Other", "0785": "Other", "99999999999": "Other",
    " 428 ": "Circulatory", "12.": "Other", ".5": "Other",
}


def test_diagnosis_groups(spark):
    got = views.diagnosis_groups(encounters(spark, diag_2=list(CODES))).collect()
    assert {r["diag_2"]: r["secondary_diagnosis_group"] for r in got} == CODES
    assert {r["primary_diagnosis_group"] for r in got} == {"Missing"}


def test_diagnosis_flags_see_every_position(spark):
    got = views.diagnosis_groups(
        encounters(
            spark,
            diag_1=["428", None, None, None],
            diag_2=[None, "786", "250.1", None],
            diag_3=["V1", "530", "585", None],
        )
    ).collect()
    flags = [[r[c] for c in S.DIAGNOSIS_FLAG_COLUMNS] for r in got]
    assert flags == [[0, 1, 0, 0, 0], [0, 0, 1, 1, 0], [1, 0, 0, 0, 1], [0, 0, 0, 0, 0]]


def test_prior_admissions(spark):
    got = views.prior_admissions(
        encounters(
            spark,
            number_inpatient=[None, 1, 2, 0, -1],
            number_emergency=[None, 1, 2, 0, 0],
            number_outpatient=[None, 0, 2, 1, 0],
        )
    ).collect()
    assert [(r["total_prior_visits"], r["utilization_tier"], r["inpatient_frequency_tier"]) for r in got] == [
        (0, "None (0 visits)", "0 visits"), (2, "Low (1-2 visits)", "1 visit"),
        (6, "High (6+ visits)", "2+ visits"), (1, "Low (1-2 visits)", "0 visits"),
        (-1, "High (6+ visits)", "2+ visits"),
    ]
    assert [r["has_prior_visits"] for r in got] == [0, 1, 1, 1, 0]


def test_feature_table_has_its_columns_and_no_join(clean, plan):
    features = views.patient_features(clean)
    assert features.columns == S.PATIENT_FEATURE_COLUMNS and len(features.columns) == 75
    text = plan(features)
    assert "Join" not in text and "Exchange" not in text


def test_joined_table_equals_the_projection(clean):
    one, joined = views.patient_features(clean), views.patient_features_joined(clean)
    assert joined.exceptAll(one).count() == 0 and one.exceptAll(joined).count() == 0


def test_joined_table_broadcasts_no_side(clean, plan):
    text = plan(views.patient_features_joined(clean))
    assert "BroadcastExchange" not in text and text.count("SortMergeJoin") == 4


def test_joined_table_refuses_repeated_ids(clean):
    twice = clean.unionByName(clean.limit(1))
    with pytest.raises(DataIntegrityError):
        views.patient_features_joined(twice)
    rows = views.patient_features_joined(twice, allow_duplicates=True).count()
    assert rows == clean.count() - 1 + 2**5


def test_bucketed_table_joins_without_a_shuffle(spark, clean):
    table = write_clean_table(clean, "bucketed_encounters", scratch_path(spark, "bucketed"), 8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = views.patient_features_joined(table)
        assert joined.count() == clean.count()
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Exchange" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE bucketed_encounters")


def test_views_by_name(spark, clean):
    views.register_views(clean)
    assert views.load_view(spark).count() == clean.count()
    assert views.load_view(spark, "age_bin_view").columns[-1] == "is_geriatric"


def test_range_join_agrees_with_the_groups(spark, clean):
    ranged = lookups.diagnosis_range_join(clean, lookups.standard_ranges(spark))
    grouped = views.diagnosis_groups(clean)
    both = ranged.filter("position = 'primary'").join(grouped, "encounter_id")
    assert both.count() == clean.count()
    assert both.filter("diagnosis_group <> primary_diagnosis_group").count() == 0


def test_range_join_keeps_overlapping_ranges(spark):
    ranges = spark.createDataFrame(
        [(390, 459, "heart"), (428, 428, "heart failure")], "low int, high int, diagnosis_group string"
    )
    rows = lookups.diagnosis_range_join(
        encounters(spark, encounter_id=[1], diag_1=["428.0"]), ranges
    ).filter("position = 'primary'")
    assert sorted(r["diagnosis_group"] for r in rows.collect()) == ["heart", "heart failure"]


def code_key(code):
    text = code.strip().upper()
    head, _, tail = text.partition(".")
    text = (head.zfill(3) if head.isdigit() and len(head) < 3 else head) + tail.replace(".", "")
    return text if re.fullmatch("[0-9A-Z]{1,7}", text) else None


def test_interval_join_against_brute_force(spark, plan):
    """Both code systems, decimals, overlapping and inverted ranges, odd and absent codes."""
    ranges = [("250", "250"), ("250.1", "250.39"), ("001", "999"), ("V10", "V19.9"), ("E10", "E14"), ("A", "ZZZZZZZ"),
              ("7", "9.5"), ("428", "401"), ("C4A", "C4A"), ("3A.1", "3B")]
    codes = ["250", "250.13", "250.4", "250.39", "250.391", "2501", "V15", "v19.95", "E11.65", "E14", "E149", "7", "8.1",
             "9.6", "C4A.1", "C4B", "M1A.0XX", "?", "", " 428 ", None, "12345678", "3A15", "0"]
    rows = spark.createDataFrame([(i, c, 7) for i, c in enumerate(codes * 3)], "id long, code string, low int")
    table = spark.createDataFrame([(a, b, f"{a}-{b}") for a, b in ranges], "low string, high string, diagnosis_group string")
    found = lookups.interval_join(rows, table)
    expected = []
    for i, code in enumerate(codes * 3):
        key = code_key(code) if code is not None else None
        inside = [
            f"{a}-{b}" for a, b in ranges
            if key and code_key(a).ljust(7, "0") <= key.ljust(7, "0") <= code_key(b).ljust(7, "Z")
        ]
        expected += [(i, code, 7, g) for g in sorted(inside) or [None]]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))
    assert lookups.range_blocks(table).groupBy("diagnosis_group").count().agg(F.max("count")).first()[0] <= 7 * 70
    assert "NestedLoop" not in plan(found) and lookups.interval_join(rows, table.limit(0)).count() == len(expected) - sum(
        len([1 for e in expected if e[0] == i]) - 1 for i in range(len(codes) * 3)
    )
