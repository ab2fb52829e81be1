import pytest

import __spark_entry__ as driver
from compare import connect, difference


def test_every_oracle_has_its_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert sum(r["encounters"] for r in rows) == 1169 and sum(r["readmissions"] for r in rows) == 121


@pytest.fixture(scope="module")
def duck(tiny):
    return connect(tiny)


@pytest.mark.parametrize("name", list(driver.oracle_sql()))
def test_query_equals_its_sql(spark, tiny, duck, name):
    result = driver.queries()[name](spark, tiny)
    assert difference(result, duck.sql(driver.oracle_sql()[name])) is None


GOLDEN = {
    "0.001": (1169, 121, 705, 387, 801, 528),
    "0.01": (11347, 1268, 6613, 3703, 7766, 5147),
}


@pytest.mark.parametrize("scale", list(GOLDEN))
def test_golden_counts(spark, scale):
    from pyspark.sql import functions as F

    row = driver.queries()["patient_features"](spark, f"/root/testdata/sf{scale}").agg(
        F.count(F.lit(1)),
        *[F.sum(c) for c in ("readmission_target", "insulin_flag", "medication_change_flag", "diabetes_med_flag")],
        F.count_if(F.col("total_prior_visits") == 0),
    ).first()
    assert tuple(row) == GOLDEN[scale]
