"""Every operator applied to the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight import schema as S
from wardlight.learning import artifacts, categories, evaluate, features, importance, models
from wardlight.learning import tree_contributions as tree_shapley
from wardlight.operators import (
    checks,
    cleaning,
    cohorts,
    encoding,
    lookups,
    metrics,
    rejects,
    scoring,
    sketches,
    views,
)
from wardlight.plans import jobs
from wardlight.session import materialize, scratch_path, tune
from wardlight.sources import bundles, catalog, files, free_bundles, landing, tables
from wardlight.sources.encounters import read_encounters

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register a query; it runs under the library's runtime settings in any session."""
    QUERIES[run.__name__] = lambda spark, data_dir: run(tune(spark), data_dir)
    return run


def _table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir}/{name}.parquet")


def _clean(spark: SparkSession, data_dir: str) -> DataFrame:
    return jobs.clean_and_encode(read_encounters(spark, data_dir))


def _features(spark: SparkSession, data_dir: str) -> DataFrame:
    return views.patient_features(_clean(spark, data_dir))


# --- cleaning and encoding ---------------------------------------------------------


@query
def encounters(spark, d):
    return read_encounters(spark, d)


@query
def normalized_names(spark, d):
    return S.normalize_columns(S.raw_header_columns(read_encounters(spark, d)))


@query
def clean_terminal(spark, d):
    return cleaning.drop_terminal_discharges(read_encounters(spark, d)).select(
        "encounter_id", "discharge_disposition_id"
    )


@query
def clean_gender(spark, d):
    return cleaning.drop_invalid_genders(read_encounters(spark, d)).select("encounter_id", "gender")


@query
def clean_tokens(spark, d):
    return cleaning.replace_missing_tokens(read_encounters(spark, d)).select(
        "encounter_id", "race", "gender", "weight", "payer_code", "medical_specialty",
        "diag_1", "diag_2", "diag_3", "max_glu_serum",
    )


@query
def clean_all(spark, d):
    return cleaning.clean_encounters(read_encounters(spark, d))


@query
def age_midpoint(spark, d):
    encoded = encoding.encode_age_midpoint(read_encounters(spark, d))
    return encoded.select("encounter_id", "age", "age_midpoint")


@query
def insulin_flag(spark, d):
    encoded = encoding.encode_insulin(read_encounters(spark, d))
    return encoded.select("encounter_id", "insulin_flag")


@query
def med_change_flag(spark, d):
    encoded = encoding.encode_medication_change(read_encounters(spark, d))
    return encoded.select("encounter_id", "medication_change_flag")


@query
def diabetes_med_flag(spark, d):
    encoded = encoding.encode_diabetes_medication(read_encounters(spark, d))
    return encoded.select("encounter_id", "diabetes_med_flag")


@query
def target(spark, d):
    encoded = encoding.encode_target(read_encounters(spark, d))
    return encoded.select("encounter_id", "readmission_target")


@query
def encode_all(spark, d):
    return _clean(spark, d)


# --- feature views and joins -------------------------------------------------------


@query
def age_bins(spark, d):
    return views.age_bins(_clean(spark, d))


@query
def stay_categories(spark, d):
    return views.stay_categories(_clean(spark, d))


@query
def diagnosis_groups(spark, d):
    return views.diagnosis_groups(_clean(spark, d)).drop(*S.DIAGNOSIS_FLAG_COLUMNS)


@query
def diagnosis_flags(spark, d):
    return views.diagnosis_groups(_clean(spark, d)).select(
        "encounter_id", *S.DIAGNOSIS_FLAG_COLUMNS
    )


@query
def prior_admissions(spark, d):
    return views.prior_admissions(_clean(spark, d))


@query
def patient_features(spark, d):
    return _features(spark, d)


@query
def patient_features_joined(spark, d):
    return views.patient_features_joined(materialize(_clean(spark, d), "clean"))


@query
def feature_view_by_name(spark, d):
    views.register_views(_clean(spark, d))
    return views.load_view(spark, "patient_features_view")


@query
def diagnosis_range_join(spark, d):
    return lookups.diagnosis_range_join(_clean(spark, d), lookups.standard_ranges(spark))


# --- integrity ---------------------------------------------------------------------


@query
def target_distribution(spark, d):
    return checks.target_distribution(_clean(spark, d))


@query
def age_stats(spark, d):
    return checks.age_statistics(_clean(spark, d))


@query
def flag_distributions(spark, d):
    return checks.flag_distributions(_clean(spark, d))


@query
def terminal_check(spark, d):
    raw = checks.terminal_discharge_count(read_encounters(spark, d)).withColumnRenamed(
        "terminal_rows", "raw_terminal_rows"
    )
    kept = checks.terminal_discharge_count(_clean(spark, d)).withColumnRenamed(
        "terminal_rows", "clean_terminal_rows"
    )
    return raw.select(F.lit("raw").alias("stage"), F.col("raw_terminal_rows").alias("terminal_rows")).unionByName(
        kept.select(F.lit("clean").alias("stage"), F.col("clean_terminal_rows").alias("terminal_rows"))
    )


@query
def clean_report(spark, d):
    return checks.clean_report(_clean(spark, d), read_encounters(spark, d).count())


@query
def key_duplicates(spark, d):
    """Patients seen more than once: the key check on a key that does repeat."""
    return checks.duplicate_keys(_clean(spark, d), "patient_nbr")


# --- sources and sinks -------------------------------------------------------------


@query
def csv_roundtrip(spark, d):
    path = scratch_path(spark, "csv")
    files.write_csv(S.raw_header_columns(read_encounters(spark, d)), path)
    return S.normalize_columns(files.read_raw_csv(spark, path))


@query
def csv_positional(spark, d):
    path = scratch_path(spark, "csv")
    files.write_csv(S.raw_header_columns(read_encounters(spark, d)), path)
    return files.read_raw_positional(spark, path)


@query
def parquet_roundtrip(spark, d):
    path = scratch_path(spark, "parquet")
    files.write_parquet(_clean(spark, d), path)
    return files.read_clean(spark, path)


@query
def clean_table(spark, d):
    path = scratch_path(spark, "table")
    files.write_parquet(_clean(spark, d), path)
    return tables.create_clean_table(spark, "wardlight_clean_encounters", path)


@query
def landing_counts(spark, d):
    source, target_path = scratch_path(spark, "csv"), scratch_path(spark, "landed")
    files.write_csv(S.raw_header_columns(read_encounters(spark, d)), source)
    return files.land_raw(spark, source, target_path)


@query
def landing_increment(spark, d):
    """Two drops of files and a third run without any: what each run landed and what is readable."""
    raw = S.raw_header_columns(read_encounters(spark, d))
    source, folder = scratch_path(spark, "drops"), scratch_path(spark, "landed")
    reports = []
    for run, half in enumerate((0, 1, None), 1):
        if half is not None:
            files.write_csv(raw.filter(F.pmod("encounter_id", F.lit(2)) == half), f"{source}/drop-{half}")
        report = landing.land_new(spark, source, folder).first()
        readable = landing.read_landed(spark, folder).count()
        reports.append((run, report["batch"], report["landed_rows"], report["corrupt_rows"], readable))
    return spark.createDataFrame(
        reports, "run int, batch long, landed_rows long, corrupt_rows long, readable_rows long"
    )


@query
def rule_rejects(spark, d):
    """Every raw encounter as the reject stream left it: where it went and the rules it broke."""
    path = scratch_path(spark, "diverted")
    valid, rejected, _ = rejects.divert(read_encounters(spark, d), rejects.intake_rules(), path)
    broken = F.concat_ws(",", rejects.BROKEN).alias("broken_rules")
    return valid.select("encounter_id", F.lit("valid").alias("side"), F.lit("").alias("broken_rules")).unionByName(
        rejected.select("encounter_id", F.lit("rejected").alias("side"), broken)
    )


@query
def rule_counts(spark, d):
    """How many rows break each rule, as observed while they were written."""
    path = scratch_path(spark, "diverted")
    _, _, counts = rejects.divert(read_encounters(spark, d), rejects.intake_rules(), path)
    return spark.createDataFrame(list(counts.items()), "rule string, n_rows long")


@query
def report_csv(spark, d):
    path = scratch_path(spark, "report")
    report = model_report(spark, d)
    files.write_report_csv(report, path)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in report.schema)
    return spark.read.schema(kinds).option("header", True).csv(path)


@query
def preprocessing_job(spark, d):
    source, target_path = scratch_path(spark, "csv"), scratch_path(spark, "clean-output")
    files.write_csv(S.raw_header_columns(read_encounters(spark, d)), source)
    stored, _ = jobs.run_preprocessing(spark, source, target_path)
    return stored


# --- evaluation --------------------------------------------------------------------

# Four rules on the length of a document stand for four models of its quality.
LENGTH_RULES = {
    "logistic_regression": ("n_chars", 500),
    "random_forest": ("-n_chars", -2000),
    "decision_tree": ("CAST(floor(n_chars / 500) AS BIGINT)", 2),
    "gbt": ("n_chars % 97", 40),
}
KNOWN_FACTS = {
    "logistic_regression": (1000, 286, 1.25, 0.45),
    "random_forest": (1000, 286, 2.5, 0.3),
    "decision_tree": (1000, 286, 1.2, 0.3),
    "gbt": (1000, 286, 3.5, 0.6),
}


def _length_predictions(spark: SparkSession, d: str) -> DataFrame:
    judged = _table(spark, d, "labels").select("doc_id", F.col("quality").alias("label"))
    lengths = _table(spark, d, "documents").select("doc_id", "n_chars")
    rules = ", ".join(
        f"struct('{m}' AS model, {score} AS score, CAST({cut} AS BIGINT) AS cut)"
        for m, (score, cut) in LENGTH_RULES.items()
    )
    return (
        judged.join(lengths, "doc_id")
        .selectExpr("doc_id", "label", f"inline(array({rules}))")
        .selectExpr(
            "model", "doc_id", "label", "score", "CAST(score >= cut AS INT) AS prediction"
        )
    )


@query
def confusion(spark, d):
    return metrics.confusion(_length_predictions(spark, d))


def _rounded(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query
def rates(spark, d):
    counted = metrics.with_rates(metrics.confusion(_length_predictions(spark, d)))
    return _rounded(counted, metrics.RATES)


@query
def auc_exact(spark, d):
    return _rounded(metrics.auc(_length_predictions(spark, d)), ["auc_roc"])


@query
def auc_encounters(spark, d):
    """Days in hospital and prior visits as scores of readmission."""
    scored = _features(spark, d).selectExpr(
        "readmission_target AS label",
        "inline(array(struct('stay' AS model, CAST(time_in_hospital AS DOUBLE) AS score),"
        " struct('visits' AS model, CAST(total_prior_visits AS DOUBLE) AS score),"
        " struct('order' AS model, CAST(encounter_id * 7919 % 100003 AS DOUBLE) AS score)))",
    )
    return _rounded(metrics.auc(scored), ["auc_roc"])


@query
def metric_checks(spark, d):
    predictions = _length_predictions(spark, d)
    figures = metrics.with_rates(metrics.confusion(predictions)).join(
        metrics.auc(predictions), "model"
    )
    return metrics.check_metrics(figures)


@query
def model_report(spark, d):
    fields = ["train_rows", "feature_dimension", "training_time_seconds", "prediction_time_seconds"]
    known = {m: dict(zip(fields, facts)) for m, facts in KNOWN_FACTS.items()}
    return metrics.comparison_report(_length_predictions(spark, d), known=known)


@query
def champion(spark, d):
    return metrics.champion(model_report(spark, d), "f1")


# --- scoring -----------------------------------------------------------------------

WEIGHTS = {
    "number_inpatient": 0.35,
    "number_emergency": 0.25,
    "time_in_hospital": 0.08,
    "num_medications": 0.01,
    "number_diagnoses": 0.04,
    "is_senior": 0.2,
    "insulin_flag": 0.1,
    "has_diabetes_diagnosis": 0.15,
}
INTERCEPT = -2.0
COHORT_WEIGHTS = [
    ("Diabetes", "insulin_flag", 2.0),
    ("Diabetes", "num_medications", 1.5),
    ("Circulatory", "is_senior", 1.25),
    ("Respiratory", "number_emergency", 1.5),
]


def _score(clean: DataFrame, carry=()) -> DataFrame:
    built = views.patient_features(clean, carry)
    return scoring.score_with_weights(built, WEIGHTS, INTERCEPT)


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return _score(_clean(spark, d))


SCORE_COLUMNS = ["encounter_id", "risk_score", "readmission_prediction", "risk_tier"]


def _stored_scores(spark: SparkSession, d: str) -> DataFrame:
    """Scored encounters as the table a scoring run leaves behind."""
    kept = [
        "encounter_id", "patient_nbr", "age_category", "stay_category",
        "primary_diagnosis_group", "utilization_tier", *WEIGHTS,
        "risk_score", "readmission_prediction", "risk_tier",
    ]
    return materialize(_scored(spark, d).select(kept), "scored")


@query
def score_fixed(spark, d):
    return _rounded(_scored(spark, d).select(SCORE_COLUMNS), ["risk_score"])


@query
def risk_tiers(spark, d):
    return _scored(spark, d).groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("encounters"), F.sum("readmission_target").alias("readmissions")
    )


# Starts of the tiers for two conditions, the usual ones elsewhere.
COHORT_STARTS = {
    "Diabetes": [("Critical", 0.7), ("High", 0.4), ("Moderate", 0.2)],
    "Circulatory": [("Critical", 0.75), ("High", 0.45), ("Moderate", 0.25)],
}


@query
def cohort_risk_tiers(spark, d):
    tiered = scoring.with_cohort_tiers(_scored(spark, d), "primary_diagnosis_group", COHORT_STARTS)
    return tiered.groupBy("primary_diagnosis_group", "cohort_risk_tier").agg(
        F.count(F.lit(1)).alias("encounters")
    )


@query
def contributions(spark, d):
    return _rounded(
        scoring.contributions(_features(spark, d), scoring.contribution_array(WEIGHTS)),
        ["contribution"],
    )


@query
def top_factors(spark, d):
    return _rounded(
        scoring.top_factors(_features(spark, d), scoring.contribution_array(WEIGHTS), 3),
        ["contribution"],
    )


@query
def top_factors_long(spark, d):
    long = scoring.contributions(_features(spark, d), scoring.contribution_array(WEIGHTS))
    return _rounded(scoring.top_factors_long(long, 3), ["contribution"])


@query
def risk_percentile(spark, d):
    scored = _rounded(_stored_scores(spark, d).select("encounter_id", "risk_score"), ["risk_score"])
    return _rounded(scoring.risk_percentiles(scored), ["risk_percentile"])


@query
def what_if(spark, d):
    scenarios = {
        "stay two days shorter": {
            "time_in_hospital": F.greatest(F.col("time_in_hospital") - 2, F.lit(1))
        },
        "no insulin": {"insulin": F.lit("No"), "insulin_flag": F.lit(0)},
    }
    changed = scoring.what_if(_clean(spark, d), scenarios, _score)
    return _rounded(changed, ["baseline_risk", "scenario_risk", "risk_change"])


@query
def disease_weights(spark, d):
    built = _features(spark, d)
    weights = spark.createDataFrame(COHORT_WEIGHTS, "cohort string, feature string, weight double")
    contributed = scoring.contributions(
        built.withColumnRenamed("primary_diagnosis_group", "cohort"),
        scoring.contribution_array(WEIGHTS),
        carry=["cohort"],
    )
    weighted = scoring.cohort_weighted(contributed, weights)
    return _rounded(weighted, ["contribution", "weighted_contribution"])


@query
def patient_profile(spark, d):
    built = _stored_scores(spark, d)
    details = built.select(
        "encounter_id", "patient_nbr", "age_category", "stay_category", "primary_diagnosis_group",
        "utilization_tier",
    )
    factors = scoring.top_factors(built, scoring.contribution_array(WEIGHTS), 3)
    profiles = scoring.patient_profiles(details, built, factors)
    return _rounded(profiles, ["risk_score", "previous_risk_score"])


@query
def risk_listing(spark, d):
    """The second page of 50 high-risk encounters."""
    page = scoring.risk_listing(_stored_scores(spark, d), 50, tier="High", page=2)
    return _rounded(page.select(SCORE_COLUMNS), ["risk_score"])


@query
def risk_listing_after(spark, d):
    """The page of 50 critical-risk encounters that follows a given id."""
    page = scoring.risk_listing(_stored_scores(spark, d), 50, tier="Critical", after=500)
    return _rounded(page.select(SCORE_COLUMNS), ["risk_score"])


@query
def first_n(spark, d):
    return scoring.first_rows(
        _features(spark, d).select("encounter_id", "patient_nbr", "readmission_target"), 20
    )


# --- the catalog and stored sketches -------------------------------------------------


def _in_catalog(spark, d):
    """Clean encounters as a table, with the rules and views beside it; a session that made none
    of them, and the table's name."""
    path, table = scratch_path(spark, "clean"), "clean_for_views"
    files.write_parquet(_clean(spark, d), path)
    tables.create_clean_table(spark, table, path)
    catalog.create_functions(spark)
    catalog.create_views(spark, table)
    return tune(spark.newSession()), table


@query
def catalog_views(spark, d):
    """The feature table as another session reads it from the catalog."""
    other, _ = _in_catalog(spark, d)
    return other.table("patient_features_view")


@query
def catalog_functions(spark, d):
    """The rules as SQL functions, called by another session."""
    other, table = _in_catalog(spark, d)
    return other.sql(
        "SELECT encounter_id, age_category(age_midpoint(age)) AS age_category, stay_category(time_in_hospital)"
        " AS stay_category, diagnosis_group(diag_1) AS primary_diagnosis_group,"
        " inpatient_frequency_tier(coalesce(number_inpatient, 0)) AS inpatient_frequency_tier"
        f" FROM {table}"
    )


@query
def sketch_percentiles(spark, d):
    """Orders as visits, summed up by day and priority, one half of the days twice; merged, and
    the merged ranks and persons held against exact ones by the sketches' stated errors."""
    visits = _table(spark, d, "orders").selectExpr(
        "o_orderdate AS admitted_at", "o_orderpriority AS cohort", "CAST(o_totalprice AS BIGINT) AS measure", "o_custkey"
    )
    path = scratch_path(spark, "sketches")
    by_day = sketches.daily_sketches(visits, "admitted_at", ["cohort"], "measure", "o_custkey")
    even = F.pmod(F.dayofyear("day"), F.lit(2)) == 0
    for part in (by_day, by_day.filter(even)):
        sketches.store_sketches(part, path)
    merged = sketches.merge_sketches(sketches.read_sketches(spark, path), ["cohort"])
    found = materialize(sketches.summary(merged), "summaries")
    below = lambda c: F.count_if(F.col("measure") < F.col(c)) / F.count("measure")
    upto = lambda c: F.count_if(F.col("measure") <= F.col(c)) / F.count("measure")
    ranks = [
        ((below(c) <= q + sketches.RANK_ERROR) & (upto(c) >= q - sketches.RANK_ERROR)).alias(f"{c}_within")
        for c, q in (("p50", 0.5), ("p90", 0.9))
    ]
    persons = F.count_distinct("o_custkey")
    near = F.abs(F.first("n_persons") - persons) <= sketches.COUNT_ERROR * persons
    return visits.join(found, "cohort").groupBy("cohort", "n_rows", "n_values", "least", "greatest").agg(
        *ranks, near.alias("persons_within")
    )


# --- cohorts, history, bundles -----------------------------------------------------


@query
def cohort_rates(spark, d):
    found = cohorts.cohort_rates(_features(spark, d), ["primary_diagnosis_group"])
    return _rounded(found, ["readmission_rate"])


@query
def cohort_subtotals(spark, d):
    found = cohorts.cohort_rates(
        _features(spark, d), ["utilization_tier", "age_category"], subtotals=True
    )
    return _rounded(found, ["readmission_rate"])


@query
def comorbidity_rates(spark, d):
    found = cohorts.comorbidity_rates(_features(spark, d), S.DIAGNOSIS_FLAG_COLUMNS)
    return _rounded(found, ["readmission_rate", "mean_prior_visits", "inpatient_share"])


@query
def prior_year_visits(spark, d):
    """Orders as visits: the urgent ones emergencies, high and medium ones stays."""
    visits = _table(spark, d, "orders").selectExpr(
        "o_orderkey AS visit_id",
        "o_custkey AS patient_nbr",
        "o_orderdate AS admitted_at",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 'emergency'"
        " WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'inpatient'"
        " ELSE 'outpatient' END AS visit_class",
    )
    return cohorts.prior_year_visits(visits).drop("admitted_at")


@query
def bundle_flatten(spark, d):
    stored = materialize(bundles.encounters_to_bundles(_clean(spark, d)), "bundles")
    return bundles.flatten_bundles(stored)


@query
def bundle_conditions(spark, d):
    return bundles.flatten_conditions(bundles.encounters_to_bundles(_clean(spark, d)))


ALL_RANKS = bundles.RANKS | {4: "diag_4", 7: "diag_7"}
OWN_SYSTEM = "urn:codes:spelled"


def _text_bundles(spark, d):
    """Bundles with text ids, five ranks and two codings a condition, the wanted one second."""
    clean = _clean(spark, d).select(
        F.concat(F.lit("ENC"), F.col("encounter_id").cast("string")).alias("encounter_id"),
        F.concat(F.lit("PAT"), F.col("patient_nbr").cast("string")).alias("patient_nbr"),
        "time_in_hospital", *bundles.RANKS.values(), F.col("diag_2").alias("diag_4"), F.col("diag_1").alias("diag_7"),
    )
    codings = {OWN_SYSTEM: lambda code: F.concat(F.lit("code "), code), bundles.ICD9: lambda code: code}
    return materialize(bundles.encounters_to_bundles(clean, ALL_RANKS, codings), "text-bundles")


@query
def bundle_codings(spark, d):
    """Every coding of every listed diagnosis, text ids and all ranks."""
    return bundles.flatten_diagnoses(_text_bundles(spark, d), id_type="string").drop("condition_id")


@query
def bundle_ranks(spark, d):
    """Diagnoses by rank: how many encounters list one, and how many codes they name."""
    listed = bundles.flatten_diagnoses(_text_bundles(spark, d), id_type="string")
    return listed.filter(F.col("system") == bundles.ICD9).groupBy("rank").agg(
        F.count(F.lit(1)).alias("n_encounters"), F.count_distinct("code").alias("n_codes")
    )


@query
def bundle_text_ids(spark, d):
    """Encounters from bundles with text ids beside the numbers of their own table of keys; the
    second half of the keys is numbered in a later run."""
    flat = materialize(bundles.flatten_bundles(_text_bundles(spark, d), id_type="string"), "flat-bundles")
    odd = F.col("encounter_id").rlike("[13579]$")
    first = materialize(free_bundles.number_keys(flat.filter(~odd), "encounter_id"), "key-numbers")
    both = materialize(free_bundles.number_keys(flat, "encounter_id", first), "key-numbers")
    return free_bundles.with_numbers(flat, "encounter_id", both, "encounter_number")


def _damaged(bundle):
    """A fault for six of ten encounters, by their id."""
    digit = F.pmod("encounter_id", F.lit(10))
    faults = [
        F.lit(None).cast("string"),
        F.substring(bundle, F.lit(1), F.length(bundle) - 3),
        F.replace(bundle, F.lit('"resourceType":"Bundle"'), F.lit('"resourceType":"List"')),
        F.lit('{"resourceType":"Bundle","entry":"none"}'),
        F.replace(bundle, F.lit('"resourceType":"Encounter",'), F.lit("")),
        F.regexp_replace(bundle, '("resourceType":"Encounter",)"id":"[^"]*",', "$1"),
    ]
    out = bundle
    for k, fault in enumerate(faults):
        out = F.when(digit == k, fault).otherwise(out)
    return out


@query
def bundle_rejects(spark, d):
    """Bundles of which six in ten are damaged: why each was put aside, and what kinds of
    resources the usable ones hold."""
    made = bundles.encounters_to_bundles(_clean(spark, d))
    number = F.get_json_object("bundle", "$.entry[0].resource.id").cast("long").alias("encounter_id")
    damaged = made.select(number, "bundle").select("encounter_id", _damaged(F.col("bundle")).alias("bundle"))
    usable, aside = free_bundles.quarantine(damaged)
    kinds = free_bundles.resources_of(usable).groupBy("resource_type").count()
    reasons = aside.groupBy("reason").count()
    return kinds.select(F.lit("resource").alias("what"), F.col("resource_type").alias("name"), F.col("count").alias("n_rows")).unionByName(
        reasons.select(F.lit("reject").alias("what"), F.col("reason").alias("name"), F.col("count").alias("n_rows"))
    )


@query
def event_properties(spark, d):
    read = bundles.read_properties(_table(spark, d, "events"), "k INT")
    return read.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.count("k").alias("with_k"),
        F.sum("k").alias("sum_k"),
        F.max("k").alias("max_k"),
    )


# --- feature vectors ---------------------------------------------------------------


@query
def string_index(spark, d):
    built = _features(spark, d)
    indexed = features.string_indexer(S.CATEGORICAL_FEATURES).fit(built).transform(built)
    return indexed.select("encounter_id", *[f"{c}_indexed" for c in S.CATEGORICAL_FEATURES])


ONE_HOT = ["race", "age_category", "stay_category", "primary_diagnosis_group", "examide"]


@query
def one_hot_long(spark, d):
    """The set position of every one-hot vector, and the vectors' sizes."""
    built = _features(spark, d)
    indexed = features.string_indexer(ONE_HOT).fit(built).transform(built)
    encoded = features.one_hot_encoder(ONE_HOT).fit(indexed).transform(indexed)
    arrays = encoded.select(
        "encounter_id", *[vector_to_array(f"{c}_vec").alias(c) for c in ONE_HOT]
    ).unpivot("encounter_id", ONE_HOT, "feature", "slots")
    return arrays.select(
        "encounter_id",
        "feature",
        (F.array_position("slots", F.lit(1.0)) - 1).alias("position"),
        F.size("slots").alias("size"),
    )


@query
def numeric_fill(spark, d):
    return features.fill_numerics(_features(spark, d)).select("encounter_id", *S.NUMERICAL_FEATURES)


@query
def scaled_numerics(spark, d):
    filled = features.fill_numerics(_features(spark, d))
    assembled = VectorAssembler(
        inputCols=S.NUMERICAL_FEATURES, outputCol=features.ASSEMBLED
    ).transform(filled)
    scaled = features.standard_scaler().fit(assembled).transform(assembled)
    values = scaled.select("encounter_id", vector_to_array("features").alias("v"))
    return values.select(
        "encounter_id", *[F.round(F.col("v")[i], 6).alias(c) for i, c in enumerate(S.NUMERICAL_FEATURES)]
    )


@query
def hash_split(spark, d):
    train, test = features.split_data(_features(spark, d))
    return train.select("encounter_id", F.lit("train").alias("side")).unionByName(
        test.select("encounter_id", F.lit("test").alias("side"))
    )


@query
def split_counts(spark, d):
    train, test = features.split_data(_features(spark, d))
    sides = train.select(F.lit("train").alias("side")).unionByName(test.select(F.lit("test").alias("side")))
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("rows"))


@query
def feature_vectors(spark, d):
    train, _, _ = jobs.prepare_training(_clean(spark, d))
    return train


# --- training ----------------------------------------------------------------------


def _trained(spark: SparkSession, d: str, name: str) -> DataFrame:
    """Test-side predictions of one classifier trained on the other encounters."""
    train, test, _ = jobs.prepare_training(_clean(spark, d))
    trained, _ = models.train_all_models(train, names=[name])
    return evaluate.predict(trained[name], test)


@query
def train_lr(spark, d):
    return _trained(spark, d, "logistic_regression")


@query
def train_rf(spark, d):
    return _trained(spark, d, "random_forest")


@query
def train_dt(spark, d):
    return _trained(spark, d, "decision_tree")


@query
def train_gbt(spark, d):
    return _trained(spark, d, "gbt")


def _embedding_training(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings as vectors, labelled by whether they belong to the first three classes."""
    from pyspark.ml.functions import array_to_vector

    return _table(spark, d, "embeddings").select(
        F.col("vec_id").alias("encounter_id"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        F.when(F.col("label") < 3, 1).otherwise(0).alias("readmission_target"),
    )


@query
def model_reload(spark, d):
    """Rows on which a stored and loaded model differs from the one stored: none."""
    data = _embedding_training(spark, d)
    train, test = features.split_data(data)
    model, _ = models.train_model("logistic_regression", train)
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    loaded = models.load_model("logistic_regression", path)
    own, again = evaluate.predict(model, test), evaluate.predict(loaded, test)
    both = own.join(again.select("encounter_id", F.col("score").alias("loaded_score")), "encounter_id")
    return both.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("score") != F.col("loaded_score")).alias("different"),
    )


@query
def prediction_contract(spark, d):
    """Every test encounter under all four classifiers: whether its probabilities are some, and the
    decision follows them."""
    train, test, _ = jobs.prepare_training(_clean(spark, d))
    trained, _ = models.train_all_models(train)
    chance = vector_to_array("probability")
    return reduce(
        DataFrame.unionByName,
        [
            model.transform(test).select(
                F.lit(name).alias("model"),
                "encounter_id",
                (chance[0].between(0, 1) & chance[1].between(0, 1) & (F.abs(chance[0] + chance[1] - 1) < 1e-9)).alias("bounded"),
                ((F.col("prediction") == 1) == (chance[1] > chance[0])).alias("decided"),
            )
            for name, model in trained.items()
        ],
    )


@query
def regression_gradient(spark, d):
    """At the regression's coefficients the slope of its penalised loss is near zero for every
    slot: training rows, and slots where it is not."""
    train, _, _ = jobs.prepare_training(_clean(spark, d))
    model, _ = models.train_model("logistic_regression", train)
    penalty = models.model_settings("logistic_regression")["regParam"]
    missed = vector_to_array("probability")[1] - F.col(S.TARGET_COLUMN)
    slots = model.transform(train).select(
        missed.alias("missed"), F.posexplode(vector_to_array("features")).alias("slot", "value")
    )
    weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(model.coefficients)], "slot int, weight double")
    slopes = slots.groupBy("slot").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.col("missed") * F.col("value")).alias("slope"),
        F.stddev_samp("value").alias("spread"),
    )
    # The penalty is on weights of values divided by their spread.
    steep = F.abs(F.col("slope") / F.col("spread") + penalty * F.col("weight") * F.col("spread")) > 1e-3
    return slopes.join(weights, "slot").agg(
        F.max("n_rows").alias("train_rows"), F.count_if((F.col("spread") > 0) & steep).alias("steep_slots")
    )


@query
def fold_sizes(spark, d):
    """Encounters of each fold of a cross-validation."""
    built = _features(spark, d)
    return built.groupBy(features.fold_of(built, 3).alias("fold")).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def report_contract(spark, d):
    """The comparison of stored models, as far as it is the same on every run."""
    report = evaluate_models(spark, d)
    rates = [F.col(c).between(0, 1) for c in ("accuracy", "precision", "recall", "f1", "auc_roc")]
    counted = (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn") == F.col("test_rows")).alias("all_counted")
    bounded = reduce(Column.__and__, rates).alias("rates_bounded")
    return report.select("model", "train_rows", "test_rows", counted, bounded)


@query
def evaluate_models(spark, d):
    train, test = features.split_data(_embedding_training(spark, d))
    folder = scratch_path(spark, "models")
    trained, records = models.train_all_models(train, test, folder)
    return evaluate.evaluate_models(trained, test, records)


@query
def feature_importance(spark, d):
    train, _, fitted = jobs.prepare_training(_clean(spark, d))
    trained, _ = models.train_all_models(train, names=["logistic_regression", "decision_tree"])
    return importance.feature_importance(spark, trained, features.vector_slots(fitted))


@query
def permutation_importance(spark, d):
    built = materialize(_features(spark, d), "features")
    train, test = features.split_data(built)
    fitted = features.fit_features(train)
    vectors = materialize(features.transform_features(train, fitted), "train")
    trained, _ = models.train_all_models(vectors, names=["decision_tree"])
    columns = ["time_in_hospital", "number_inpatient", "primary_diagnosis_group", "age_category"]
    return importance.permutation_importance(fitted, trained["decision_tree"], test, columns)


@query
def model_factors(spark, d):
    """Three leading factors of every test encounter under a trained regression."""
    train, test, fitted = jobs.prepare_training(_clean(spark, d))
    trained, _ = models.train_all_models(train, names=["logistic_regression"])
    parts = scoring.model_contribution_array(
        trained["logistic_regression"], features.vector_slots(fitted)
    )
    return scoring.top_factors(test, parts, 3)


@query
def score_with_model(spark, d):
    train, test, _ = jobs.prepare_training(_clean(spark, d))
    trained, _ = models.train_all_models(train, names=["decision_tree"])
    return scoring.score_with_model(test, trained["decision_tree"]).select(SCORE_COLUMNS)


@query
def cross_validate(spark, d):
    _, found = models.cross_validate(
        _embedding_training(spark, d),
        "logistic_regression",
        {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5]},
        folds=3,
    )
    return found


@query
def champion_artifact(spark, d):
    train, test = features.split_data(_embedding_training(spark, d))
    folder = scratch_path(spark, "models")
    trained, records = models.train_all_models(train, test, folder)
    report = evaluate.evaluate_models(trained, test, records)
    return evaluate.store_champion(
        trained, report, folder, "f1", models.all_model_settings(), train.schema.simpleString()
    )


# --- artifacts and jobs ------------------------------------------------------------

SCORE_DAYS = ("2024-05-01", "2024-05-02")


def fixed_weight_pipeline():
    """The fixed weights as a stored pipeline: what any classifier's artifact looks like."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer

    # The intercept comes first, as in score_with_weights: in another order a sum may miss a tier by its last bit.
    margin = " + ".join([f"({INTERCEPT}D)", *(f"coalesce(CAST({c} AS DOUBLE), 0D) * {w}D" for c, w in WEIGHTS.items())])
    chance = f"1D / (1D + exp(-({margin})))"
    return PipelineModel(
        stages=[
            SQLTransformer(statement=f"SELECT *, 1D - {chance} AS _other, {chance} AS _chance FROM __THIS__"),
            VectorAssembler(inputCols=["_other", "_chance"], outputCol="probability"),
        ]
    )


@query
def batch_score_job(spark, d):
    """Raw CSV scored by a stored champion, on two days, the first of them twice."""
    source, folder, scored = (scratch_path(spark, x) for x in ("csv", "artifacts", "scores"))
    files.write_csv(S.raw_header_columns(read_encounters(spark, d)), source)
    signature = artifacts.signature_of(_features(spark, d), list(WEIGHTS))
    version = artifacts.publish(spark, folder, fixed_weight_pipeline(), signature)
    artifacts.promote(spark, folder, version, None)
    for day in (*SCORE_DAYS, SCORE_DAYS[0]):
        jobs.run_scoring(spark, source, folder, scored, day)
    stored = spark.read.parquet(scored)
    return _rounded(
        stored.select(*SCORE_COLUMNS, "model_version", F.col("score_date").cast("string").alias("score_date")),
        ["risk_score"],
    )


@query
def tree_contributions(spark, d):
    """Contributions of two tree models to every test row: how many rows, and on how many the
    base and contributions do not make up the model's own output."""
    train, test, fitted = jobs.prepare_training(_clean(spark, d))
    slots, found = features.vector_slots(fitted), []
    for name, output, changed in (
        ("decision_tree", "probability", {}), ("gbt", "rawPrediction", {"maxIter": 5})
    ):
        model, _ = models.train_model(name, train, **changed)
        parts, base = tree_shapley.tree_contributions(test, model, slots)
        own = model.transform(test).select("encounter_id", vector_to_array(output)[1].alias("own"))
        total = F.aggregate("contributions", F.lit(base), lambda a, p: a + p["contribution"])
        checked = parts.select("encounter_id", "score", total.alias("total")).join(own, "encounter_id")
        wrong = (F.abs(F.col("total") - F.col("own")) > 1e-9) | (F.abs(F.col("score") - F.col("own")) > 1e-9)
        found.append(checked.agg(F.count(F.lit(1)).alias("rows"), F.count_if(wrong).alias("wrong_rows")).select(F.lit(name).alias("model"), "*"))
    return found[0].unionByName(found[1])


@query
def category_index(spark, d):
    """The indexes of a string indexer from tables of categories."""
    built = _features(spark, d)
    table = categories.fit_categories(built, S.CATEGORICAL_FEATURES)
    indexed = categories.index_categories(built, table)
    return indexed.select("encounter_id", *[f"{c}_indexed" for c in S.CATEGORICAL_FEATURES])


WIDE_COLUMNS = ["o_custkey", "o_orderdate", "o_totalprice"]


@query
def category_index_wide(spark, d):
    """Columns with nearly as many values as rows."""
    orders = _table(spark, d, "orders").select("o_orderkey", *WIDE_COLUMNS)
    named = orders.withColumns(
        {"o_totalprice": F.format_string("%.2f", "o_totalprice"), "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd")}
    )
    indexed = categories.index_categories(named, categories.fit_categories(named, WIDE_COLUMNS))
    return indexed.select("o_orderkey", *[f"{c}_indexed" for c in WIDE_COLUMNS])


# Ranges of both code systems that overlap, some of them within a three-character code.
CODE_RANGES = [
    ("001", "139", "Infections"), ("240", "279", "Endocrine"), ("250", "250", "Diabetes"),
    ("250.1", "250.3", "Diabetes with coma"), ("390", "459", "Circulatory"), ("401", "405.9", "Hypertension"),
    ("428", "428.9", "Heart failure"), ("428.2", "428.4", "Heart failure, by kind"), ("V10", "V19", "History"),
    ("E800", "E999", "External causes"), ("E10", "E14", "Diabetes"), ("I10", "I16.9", "Hypertension"),
    ("7", "9.5", "Intestinal"),
]


@query
def interval_join(spark, d):
    ranges = spark.createDataFrame(CODE_RANGES, "low string, high string, diagnosis_group string")
    return lookups.interval_join(lookups.long_diagnoses(_clean(spark, d)), ranges)


@query
def roc_points(spark, d):
    return _rounded(
        metrics.roc_points(_length_predictions(spark, d)), ["true_positive_rate", "false_positive_rate", "precision"]
    )


@query
def threshold_choice(spark, d):
    """A missed case costs five false alarms."""
    return metrics.choose_threshold(metrics.roc_points(_length_predictions(spark, d)), 1.0, 5.0)
