import pytest
from pyspark.sql import functions as F

from registry.queries import INTERCEPT, WEIGHTS, _score, fixed_weight_pipeline
from wardlight.functions.clinical import risk_tier
from wardlight.operators import scoring
from wardlight.session import materialize


@pytest.fixture(scope="module")
def scored(clean):
    return materialize(_score(clean), "scored")


def test_tiers(spark):
    values = {0.0: "Low", 0.18: "Low", 0.25: "Moderate", 0.5: "High", 0.742: "High", 0.8: "Critical", 0.81: "Critical", None: None}
    df = spark.createDataFrame([(v,) for v in values], "p double").select("p", risk_tier(F.col("p")).alias("t"))
    assert {r["p"]: r["t"] for r in df.collect()} == values
    own = spark.range(1).select(risk_tier(F.lit(0.3), [("High", 0.2), ("Critical", 0.9)]).alias("t"))
    assert own.first()["t"] == "High"


def test_stored_weights_score_as_the_weights_do(spark):
    """To the last bit: margins that are nought in one order of the sum only fall into another tier."""
    edge = [(1, 2, 3, 40, 4, 1, 0, 1), (2, 0, 8, 15, 4, 1, 0, 1), (3, 0, 2, 15, 16, 0, 0, 0), (3, 0, 5, 15, 10, 0, 0, 0)]
    rows = spark.createDataFrame(edge, ", ".join(f"{c} int" for c in WEIGHTS))
    own = scoring.score_with_weights(rows, WEIGHTS, INTERCEPT).select(*WEIGHTS, "risk_score", "risk_tier")
    stored = scoring.score_with_model(rows, fixed_weight_pipeline()).select(*WEIGHTS, "risk_score", "risk_tier")
    assert sorted(own.collect()) == sorted(stored.collect())
    assert {r["risk_tier"] for r in stored.collect()} == {"High"}


def test_missing_inputs_add_nothing(spark):
    df = spark.createDataFrame([(None, 2)], "a int, b int")
    row = scoring.score_with_weights(df, {"a": 5.0, "b": 1.0}, -2.0).first()
    assert row["risk_score"] == 0.5 and row["readmission_prediction"] == 1 and row["risk_tier"] == "High"


def test_contributions_add_up_to_the_margin(scored):
    sums = scoring.contributions(scored, scoring.contribution_array(WEIGHTS)).groupBy("encounter_id").agg(
        F.sum("contribution").alias("s")
    )
    off = sums.join(scored, "encounter_id").filter(
        F.abs(F.lit(1) / (1 + F.exp(-(F.col("s") + INTERCEPT))) - F.col("risk_score")) > 1e-9
    )
    assert off.count() == 0


def test_top_factors_need_no_shuffle(scored, plan):
    top = scoring.top_factors(scored, scoring.contribution_array(WEIGHTS), 3)
    assert "Exchange" not in plan(top)
    long = scoring.top_factors_long(scoring.contributions(scored, scoring.contribution_array(WEIGHTS)), 3)
    assert top.exceptAll(long).count() == 0 and long.exceptAll(top).count() == 0


def test_percentiles_with_a_hot_score(spark):
    values = [0.5] * 40 + [i / 100 for i in range(60)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, risk_score double")
    got = {r["id"]: r["risk_percentile"] for r in scoring.risk_percentiles(df, pieces=7).collect()}
    assert got == pytest.approx({i: sum(x < v for x in values) / 99 for i, v in enumerate(values)})
    one = scoring.risk_percentiles(df.limit(1)).first()
    assert one["risk_percentile"] == 0.0


def test_what_if_changes_what_follows(clean):
    scenarios = {
        "two weeks": {"time_in_hospital": F.lit(14)},
        "no history": {c: F.lit(0) for c in ("number_inpatient", "number_emergency", "number_outpatient")},
        "as is": {},
    }
    out = scoring.what_if(clean, scenarios, _score)
    rows = clean.count()
    assert {r["scenario"]: r["count"] for r in out.groupBy("scenario").count().collect()} == dict.fromkeys(scenarios, rows)
    assert out.filter("scenario = 'as is' AND risk_change <> 0").count() == 0
    assert out.filter("scenario = 'two weeks' AND risk_change < 0").count() == 0
    assert out.filter("scenario = 'no history' AND risk_change > 0").count() == 0
    assert out.filter("scenario = 'no history' AND risk_change < 0").count() > 0


def test_what_if_needs_no_shuffle_or_join(clean, plan):
    text = plan(scoring.what_if(clean, {"x": {"time_in_hospital": F.lit(1)}}, _score))
    assert "Exchange" not in text and "Join" not in text


def test_pages_cover_everything_once(scored):
    by_page, by_key, last = [], [], None
    for page in range(1, 5):
        by_page += [r[0] for r in scoring.risk_listing(scored, 20, "High", page=page).collect()]
        got = [r[0] for r in scoring.risk_listing(scored, 20, "High", after=last).collect()]
        by_key, last = by_key + got, got[-1]
    wanted = sorted(r[0] for r in scored.filter("risk_tier = 'High'").select("encounter_id").collect())
    assert by_page == by_key == wanted[:80]


def test_listing_filters_at_the_scan(scored, plan):
    text = plan(scoring.risk_listing(scored, 20, "High", after=5))
    assert "EqualTo(risk_tier,High)" in text and "GreaterThan(encounter_id,5)" in text
    assert "TakeOrderedAndProject" in text


def test_cohort_weights_default_to_one(spark):
    rows = spark.createDataFrame(
        [(1, "Diabetes", "a", 0.5), (1, "Diabetes", "b", 0.25), (2, "Other", "a", 0.5)],
        "encounter_id long, cohort string, feature string, contribution double",
    )
    weights = spark.createDataFrame([("Diabetes", "a", 3.0)], "cohort string, feature string, weight double")
    got = {(r[0], r["feature"]): r["weighted_contribution"] for r in scoring.cohort_weighted(rows, weights).collect()}
    assert got == {(1, "a"): 1.5, (1, "b"): 0.25, (2, "a"): 0.5}


def test_profiles_follow_the_patient(scored):
    factors = scoring.top_factors(scored, scoring.contribution_array(WEIGHTS), 3)
    profiles = scoring.patient_profiles(scored.select("encounter_id", "patient_nbr"), scored, factors, pieces=5)
    expected, last = {}, {}
    for r in sorted(scored.select("encounter_id", "patient_nbr", "risk_score").collect()):
        expected[r[0]] = last.get(r[1])
        last[r[1]] = r[2]
    got = profiles.collect()
    assert {r["encounter_id"]: r["previous_risk_score"] for r in got} == expected
    assert all(r["factor_1"] and r["factor_3"] for r in got)


def test_profiles_have_as_many_factors_as_asked_for(scored):
    some = scored.limit(20)
    factors = scoring.top_factors(some, scoring.contribution_array(WEIGHTS), 5)
    details = some.select("encounter_id", "patient_nbr")
    profiles = scoring.patient_profiles(details, some, factors, pieces=2, k=5).collect()
    named = {(r["encounter_id"], r["factor_rank"]): r["feature"] for r in factors.collect()}
    assert len(named) > 3 * len(profiles)
    assert {(r["encounter_id"], i): r[f"factor_{i}"] for r in profiles for i in range(1, 6) if r[f"factor_{i}"]} == named
