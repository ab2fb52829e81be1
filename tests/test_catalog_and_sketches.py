import datetime

import pytest
from pyspark.sql import functions as F

from wardlight.functions import clinical as fn
from wardlight.operators import sketches, views
from wardlight.session import scratch_path
from wardlight.sources import catalog, files, tables


@pytest.fixture(scope="module")
def other(spark, clean):
    path = scratch_path(spark, "clean")
    files.write_parquet(clean, path)
    tables.create_clean_table(spark, "catalog_clean", path)
    catalog.create_functions(spark), catalog.create_views(spark, "catalog_clean")
    return spark.newSession()


@pytest.mark.parametrize("name", list(views.VIEWS))
def test_views_equal_their_frames(spark, clean, other, name):
    read, built = other.table(name), views.VIEWS[name](clean)
    assert read.columns == built.columns and [t for _, t in read.dtypes] == [t for _, t in built.dtypes]
    rows = [tuple(r) for r in read.orderBy("encounter_id").collect()]
    assert rows == [tuple(r) for r in built.orderBy("encounter_id").collect()]


def test_views_push_down(other, plan):
    read = plan(other.sql("SELECT age_category FROM age_bin_view WHERE patient_nbr = 7"))
    assert "EqualTo(patient_nbr,7)" in read and "ReadSchema: struct<patient_nbr:bigint,age_midpoint:int>" in read


def test_functions_on_odd_values(spark, other):
    rows = other.sql(
        "SELECT age_midpoint('[70-80)'), age_midpoint('x'), diagnosis_group('250.1'), diagnosis_group(NULL),"
        " diagnosis_group('V57'), risk_tier(0.5), risk_tier(NULL), stay_category(2), is_diabetes_code('251')"
    ).first()
    assert tuple(rows) == (75, None, "Diabetes", "Missing", "Other", "High", None, "Short", False)
    codes = spark.createDataFrame([(c,) for c in ("390", " 460.1", "785", "E909", "?", "", "1e3", None)], "code string")
    codes.createOrReplaceTempView("odd_codes")
    head = fn.code_head(F.col("code"))
    want = codes.select(fn.diagnosis_group(F.col("code"), head, fn.code_number(head))).collect()
    assert [r[0] for r in spark.sql("SELECT default.diagnosis_group(code) FROM odd_codes").collect()] == [r[0] for r in want]


def test_only_projections_are_written(spark):
    with pytest.raises(ValueError, match="Aggregate"):
        catalog.select_text(spark.range(0).groupBy().count(), "t")


DAY = datetime.date(2024, 1, 1)


def visits(spark, rows):
    return spark.createDataFrame(rows, "at date, cohort string, stay int, person string")


def test_sketches_of_few_rows_are_exact(spark):
    rows = visits(spark, [(DAY, "a", 3, "p"), (DAY, "a", 5, "p"), (DAY, "a", None, None), (DAY, None, None, "q"), (None, "a", 1, "r")])
    merged = sketches.merge_sketches(sketches.daily_sketches(rows, "at", ["cohort"], "stay", "person"), ["cohort"])
    found = {r["cohort"]: r.asDict() for r in sketches.summary(merged).collect()}
    a = found["a"]
    assert (a["n_rows"], a["n_values"], a["least"], a["p50"], a["greatest"], a["n_persons"]) == (4, 3, 1, 3, 5, 2)
    n = found[None]
    assert (n["n_rows"], n["n_values"], n["least"], n["p90"], n["n_persons"]) == (1, 0, None, None, 1)


def test_a_day_is_replaced_and_a_span_is_read(spark, plan):
    path = scratch_path(spark, "sketches")
    days = [DAY + datetime.timedelta(k) for k in range(3)]

    def store(rows):
        sketches.store_sketches(sketches.daily_sketches(visits(spark, rows), "at", ["cohort"], "stay", "person"), path)

    store([(d, "a", 10 * k, f"p{k}") for k, d in enumerate(days)])
    store([(days[1], "a", 99, "x"), (days[1], "b", 98, "y")])
    span = sketches.read_sketches(spark, path, "2024-01-02", "2024-01-03")
    assert "PartitionFilters: [isnotnull(day" in plan(span)
    row = sketches.summary(sketches.merge_sketches(span, [])).first()
    assert (row["n_rows"], row["least"], row["greatest"], row["n_persons"]) == (3, 20, 99, 3)
    assert sketches.read_sketches(spark, path).count() == 4


def test_a_hot_cohort_stays_within_the_errors(spark):
    rows = spark.range(60_000).select(
        F.lit(DAY).alias("at"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 50)).alias("cohort"),
        (F.col("id") * 7919 % 60_000).alias("stay"), (F.col("id") % 20_000).cast("string").alias("person"),
    )
    daily = sketches.daily_sketches(rows, "at", ["cohort"], "stay", "person")
    row = sketches.summary(sketches.merge_sketches(daily, [])).first()
    assert row["n_rows"] == 60_000 and abs(row["p90"] / 60_000 - 0.9) <= sketches.RANK_ERROR
    assert abs(row["n_persons"] / 20_000 - 1) <= sketches.COUNT_ERROR


def test_empty_table(spark):
    daily = sketches.daily_sketches(visits(spark, []), "at", ["cohort"], "stay", "person")
    assert sketches.summary(sketches.merge_sketches(daily, ["cohort"])).count() == 0
