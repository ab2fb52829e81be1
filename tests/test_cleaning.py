import pytest

from wardlight.operators import cleaning, encoding
from wardlight.schema import normalize_name


def ids(df):
    return sorted(r[0] for r in df.select("encounter_id").collect())


def test_terminal_discharges(spark):
    rows = [(1, 1), (2, 11), (3, 13), (4, 3), (5, 19), (6, None)]
    df = spark.createDataFrame(rows, "encounter_id long, discharge_disposition_id long")
    assert ids(cleaning.drop_terminal_discharges(df)) == [1, 4]


def test_terminal_discharges_given_as_text(spark):
    rows = [(1, "1"), (2, "11"), (3, "x")]
    df = spark.createDataFrame(rows, "encounter_id long, discharge_disposition_id string")
    assert ids(cleaning.drop_terminal_discharges(df)) == [1]


def test_invalid_genders(spark):
    rows = [(1, "Female"), (2, "Male"), (3, "Unknown/Invalid"), (4, None), (5, "unknown/invalid")]
    df = spark.createDataFrame(rows, "encounter_id long, gender string")
    assert ids(cleaning.drop_invalid_genders(df)) == [1, 2, 5]


def test_missing_tokens_leave_other_text_as_it_is(spark):
    rows = [("?", " ? ", 1), (" Cardiology", "None", 2), (None, "??", 3)]
    df = spark.createDataFrame(rows, "race string, lab string, n int")
    got = cleaning.replace_missing_tokens(df).collect()
    assert [tuple(r) for r in got] == [(None, None, 1), (" Cardiology", "None", 2), (None, "??", 3)]
    only = cleaning.replace_missing_tokens(df, columns=["race", "absent"]).collect()
    assert only[0]["lab"] == " ? " and only[0]["race"] is None


def test_missing_gender_marker_survives_as_null(spark):
    df = spark.createDataFrame(
        [(1, 1, "?")], "encounter_id long, discharge_disposition_id int, gender string"
    )
    assert cleaning.clean_encounters(df).first()["gender"] is None


AGES = [(f"[{d * 10}-{d * 10 + 10})", d * 10 + 5) for d in range(10)] + [
    ("20-30", 25), ("[40-60]", 50), ("(20-40)", 30), ("[0-5)", 2), ("70 - 80", 75),
    (None, None), ("", None), ("invalid_age", None), ("[50)", None),
]


def test_age_midpoints(spark):
    df = spark.createDataFrame(AGES, "age string, expected int")
    got = encoding.encode_age_midpoint(df).collect()
    assert [(r["age"], r["age_midpoint"]) for r in got] == AGES


@pytest.mark.parametrize(
    "encode, source, to, values",
    [
        (encoding.encode_insulin, "insulin", "insulin_flag",
         {"No": 0, "Up": 1, "Steady": 1, "Down": 1, None: 0}),
        (encoding.encode_medication_change, "change", "medication_change_flag",
         {"Ch": 1, "No": 0, None: 0}),
        (encoding.encode_diabetes_medication, "diabetesmed", "diabetes_med_flag",
         {"Yes": 1, "No": 0, None: 0}),
        (encoding.encode_target, "readmitted", "readmission_target",
         {"<30": 1, ">30": 0, "NO": 0, "No": None, None: None}),
    ],
)
def test_flags(spark, encode, source, to, values):
    df = spark.createDataFrame([(k,) for k in values], f"{source} string")
    assert {r[source]: r[to] for r in encode(df).collect()} == values


def test_names():
    assert normalize_name("Glyburide-Metformin") == "glyburide_metformin"
    assert normalize_name("DIABETESMED") == "diabetesmed"


def test_cleaning_reads_without_a_shuffle(clean, plan):
    cleaned = encoding.encode_encounters(cleaning.clean_encounters(clean))
    assert "Exchange" not in plan(cleaned)


def test_filters_reach_the_scan(clean, plan):
    text = plan(cleaning.clean_encounters(clean).select("encounter_id"))
    pushed = text.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "discharge_disposition_id" in pushed and "gender" in pushed
    assert "metformin" not in text.split("ReadSchema")[1]
