import pytest
from pyspark.sql import functions as F

from wardlight import schema as S
from wardlight.errors import DataIntegrityError, FeatureValidationError, SchemaValidationError
from wardlight.operators import checks


def test_column_counts():
    assert len(S.RAW_COLUMNS) == 50 and len(S.CLEAN_COLUMNS) == 55
    assert len(S.CATEGORICAL_FEATURES) == 41 and len(S.NUMERICAL_FEATURES) == 26
    assert not set(S.FEATURE_COLUMNS) & set(S.EXCLUDED_COLUMNS)


def test_input_columns(spark):
    df = spark.createDataFrame([("a", "b")], "col_a string, `COL-B` string")
    checks.validate_input_columns(df, ["col_a", "col_b"])
    with pytest.raises(SchemaValidationError, match="col_c"):
        checks.validate_input_columns(df, ["col_a", "col_c"])
    with pytest.raises(SchemaValidationError):
        checks.validate_output_columns(df)


def test_target_values(spark):
    good = spark.createDataFrame([(0,), (1,), (0,)], "readmission_target long")
    assert checks.validate_target_values(good) == {0: 2, 1: 1}
    for bad in (2, None):
        df = spark.createDataFrame([(0,), (bad,)], "readmission_target long")
        with pytest.raises(DataIntegrityError):
            checks.validate_target_values(df)
    with pytest.raises(SchemaValidationError):
        checks.validate_target_values(good, "absent")


def test_age_range(spark):
    def ages(*values):
        return spark.createDataFrame([(v,) for v in values], "age_midpoint long")

    assert checks.validate_age_range(ages(0, 120)) == {"min_age": 0, "max_age": 120, "total_records": 2}
    for bad in ([55, 150], [-1], [None]):
        with pytest.raises(DataIntegrityError):
            checks.validate_age_range(ages(*bad))
    assert checks.validate_age_range(ages()) == {"min_age": None, "max_age": None, "total_records": 0}


def test_flags(spark):
    df = spark.createDataFrame([(0, 1), (1, 1)], "a int, b int")
    assert checks.validate_binary_flags(df, ["a", "b"]) == {"a": {0: 1, 1: 1}, "b": {1: 2}}
    for bad in (None, 2):
        with pytest.raises(DataIntegrityError, match="b"):
            checks.validate_binary_flags(
                spark.createDataFrame([(0, bad), (1, 1)], "a int, b int"), ["a", "b"]
            )


def test_terminal_discharges(spark):
    df = spark.createDataFrame([(1,), (20,)], "discharge_disposition_id int")
    with pytest.raises(DataIntegrityError):
        checks.validate_no_terminal_discharges(df)
    checks.validate_no_terminal_discharges(df.limit(1))
    with pytest.raises(SchemaValidationError):
        checks.validate_no_terminal_discharges(df, "absent")


def test_report_of_clean_data(clean):
    row = checks.validate_cleaned_encounters(clean, 1500)
    assert (row["output_row_count"], row["rows_removed"]) == (1169, 331)
    assert row["readmission_target_1"] == 121 and row["insulin_flag_1"] == 705
    assert row["medication_change_flag_1"] == 387 and row["diabetes_med_flag_1"] == 801
    assert row["total_columns"] == 55


@pytest.mark.parametrize(
    "column, value",
    [("age_midpoint", 130), ("insulin_flag", 2), ("readmission_target", None),
     ("discharge_disposition_id", 13), ("age_midpoint", None)],
)
def test_report_fails_on_one_bad_row(clean, column, value):
    kind = clean.schema[column].dataType
    bad = clean.limit(1).withColumn(column, F.lit(value).cast(kind)).unionByName(clean)
    with pytest.raises(DataIntegrityError):
        checks.validate_cleaned_encounters(bad)


def test_report_is_one_aggregation(clean, plan):
    text = plan(checks.clean_report(clean))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "metformin" not in text.split("ReadSchema")[1]


def test_report_of_an_empty_frame(clean):
    row = checks.clean_report(clean.limit(0), 0).first()
    assert row["status"] == "PASSED" and row["output_row_count"] == 0 and row["min_age"] is None


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "encounter_id long")
    assert [tuple(r) for r in checks.duplicate_keys(df).collect()] == [(2, 2)]
    with pytest.raises(DataIntegrityError):
        checks.require_unique(df)


def test_feature_columns(features):
    checks.validate_feature_columns(features)
    checks.validate_feature_columns(S.FEATURE_COLUMNS, require_target=False)
    with pytest.raises(FeatureValidationError, match="target"):
        checks.validate_feature_columns(S.FEATURE_COLUMNS)
    with pytest.raises(FeatureValidationError, match="diabetesmed"):
        names = ["diabetesMed" if c == "diabetesmed" else c for c in S.FEATURE_COLUMNS]
        checks.validate_feature_columns(names, require_target=False)
    with pytest.raises(FeatureValidationError, match="age_midpoint"):
        checks.validate_feature_columns(set(S.CATEGORICAL_FEATURES), require_target=False)
    with pytest.raises(TypeError):
        checks.validate_feature_columns(42)
