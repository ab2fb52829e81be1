import datetime as dt
import random

from wardlight.operators.cohorts import VISIT_CLASSES, cohort_rates, prior_year_visits


def history(spark, rows):
    return spark.createDataFrame(
        rows, "visit_id long, patient_nbr long, admitted_at timestamp_ntz, visit_class string"
    )


def test_prior_year_equals_counting(spark):
    """One patient holds a third of the visits, many of them on the same days."""
    rng = random.Random(11)
    start = dt.datetime(2020, 1, 1)
    rows = [
        (
            i,
            1 if rng.random() < 0.34 else rng.randrange(2, 60),
            start + dt.timedelta(days=rng.randrange(900), hours=rng.randrange(24)),
            rng.choice(VISIT_CLASSES),
        )
        for i in range(900)
    ]
    expected = {
        i: tuple(
            sum(
                p == q and c == k and 1 <= (t.date() - u.date()).days <= 365
                for _, q, u, k in rows
            )
            for c in VISIT_CLASSES
        )
        for i, p, t, _ in rows
    }
    got = prior_year_visits(history(spark, rows).repartition(5)).collect()
    assert {r["visit_id"]: tuple(r[f"prior_{c}"] for c in VISIT_CLASSES) for r in got} == expected
    assert all(r["prior_total"] == sum(expected[r["visit_id"]]) for r in got)


def test_window_edges(spark):
    day = dt.datetime(2021, 3, 1)
    rows = [
        (1, 1, day - dt.timedelta(days=366), "inpatient"),
        (2, 1, day - dt.timedelta(days=365), "inpatient"),
        (3, 1, day - dt.timedelta(days=1), "emergency"),
        (4, 1, day, "outpatient"),
        (5, 1, day + dt.timedelta(hours=5), "inpatient"),
        (6, 2, day, "inpatient"),
    ]
    got = {r["visit_id"]: r for r in prior_year_visits(history(spark, rows)).collect()}
    assert [got[4][f"prior_{c}"] for c in VISIT_CLASSES] == [1, 1, 0]
    assert got[5]["prior_total"] == 2 and got[6]["prior_total"] == 0 and got[1]["prior_total"] == 0


def test_visits_are_counted_before_they_are_shuffled(spark, plan):
    rows = [(i, i, dt.datetime(2020, 1, 1), "inpatient") for i in range(20)]
    text = plan(prior_year_visits(history(spark, rows)))
    window = text[text.index("Window ["):]
    assert window.count("FileScan") == 1 and "daily-visits" in window


def test_a_hot_day_stays_out_of_the_shuffle(spark, plan):
    """One patient's day holds most visits, and unknown patients hold many."""
    from pyspark.sql import functions as F

    n = F.col("id")
    visits = spark.range(0, 3000, 1, 6).select(
        n.alias("visit_id"),
        F.when(n % 3 == 0, F.lit(-1)).when(n % 3 == 1, n).alias("patient_nbr"),
        F.when(n % 30 == 0, F.lit("2020-01-01 08:00:00")).otherwise(F.lit("2020-01-02 09:00:00"))
        .cast("timestamp_ntz").alias("admitted_at"),
        F.lit("inpatient").alias("visit_class"),
    )
    joined = prior_year_visits(visits)
    assert "LeftAnti" in plan(joined) and "LeftSemi" in plan(joined)
    got = {r["visit_id"]: r["prior_total"] for r in joined.collect()}
    assert got == {i: 100 if i % 3 == 0 and i % 30 else 0 for i in range(3000)}


def test_cohorts(spark):
    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "y", 0), ("b", "x", 0)], "g string, t string, readmission_target int"
    )
    flat = {r["g"]: (r["encounters"], r["readmissions"], r["readmission_rate"]) for r in cohort_rates(df, ["g"]).collect()}
    assert flat == {"a": (2, 1, 0.5), "b": (1, 0, 0.0)}
    totals = cohort_rates(df, ["g", "t"], subtotals=True).collect()
    assert len(totals) == 6
    assert next(r for r in totals if r["g"] is None)["encounters"] == 3
