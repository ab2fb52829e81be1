"""The same results as plain SQL over the given tables, written on their own terms.

Each text starts from the encounter derivation and repeats a query's meaning with
joins and windows an engine without the library can run.
"""

from __future__ import annotations

from registry.queries import (
    CODE_RANGES,
    COHORT_STARTS,
    COHORT_WEIGHTS,
    INTERCEPT,
    KNOWN_FACTS,
    LENGTH_RULES,
    ONE_HOT,
    SCORE_DAYS,
    WEIGHTS,
    WIDE_COLUMNS,
)
from wardlight import schema as S
from wardlight.functions.clinical import RISK_TIER_STARTS
from wardlight.sources.encounters import encounter_sql

RAW = ", ".join(S.RAW_COLUMNS)
TERMINAL = "(11, 13, 14, 19, 20, 21)"


def _token(c: str) -> str:
    return f"CASE WHEN trim({c}) = '?' THEN NULL ELSE {c} END AS {c}"


ENC = f"enc AS ({encounter_sql()})"
CLEAN = (
    "clean AS (SELECT "
    + ", ".join(_token(c) if c in S.STRING_COLUMNS else c for c in S.RAW_COLUMNS)
    + f" FROM enc WHERE discharge_disposition_id NOT IN {TERMINAL}"
    " AND gender IS NOT NULL AND gender <> 'Unknown/Invalid')"
)
AGE = (
    r"CAST(trunc((TRY_CAST(regexp_extract(age, '(\d+)\s*-\s*(\d+)', 1) AS INT)"
    r" + TRY_CAST(regexp_extract(age, '(\d+)\s*-\s*(\d+)', 2) AS INT)) / 2) AS INT)"
)
INSULIN = "CASE WHEN insulin IN ('Up', 'Down', 'Steady') THEN 1 ELSE 0 END"
CHANGE = "CASE WHEN change = 'Ch' THEN 1 ELSE 0 END"
MEDICATION = "CASE WHEN diabetesmed = 'Yes' THEN 1 ELSE 0 END"
TARGET = "CASE WHEN readmitted = '<30' THEN 1 WHEN readmitted IN ('>30', 'NO') THEN 0 END"
ENCODED = (
    f"encoded AS (SELECT {RAW}, {AGE} AS age_midpoint, {INSULIN} AS insulin_flag,"
    f" {CHANGE} AS medication_change_flag, {MEDICATION} AS diabetes_med_flag,"
    f" {TARGET} AS readmission_target FROM clean)"
)


def _number(c: str) -> str:
    return f"TRY_CAST(split_part({c}, '.', 1) AS INT)"


def _head(c: str) -> str:
    return f"split_part({c}, '.', 1)"


def _group(c: str) -> str:
    n, h = _number(c), _head(c)
    return (
        f"CASE WHEN {c} IS NULL OR trim({c}) = '' OR trim({c}) = '?' THEN 'Missing'"
        f" WHEN {c} LIKE '250%' THEN 'Diabetes'"
        f" WHEN {n} BETWEEN 390 AND 459 OR {h} = '785' THEN 'Circulatory'"
        f" WHEN {n} BETWEEN 460 AND 519 OR {h} = '786' THEN 'Respiratory'"
        f" WHEN {n} BETWEEN 520 AND 579 OR {h} = '787' THEN 'Digestive'"
        f" WHEN {n} BETWEEN 580 AND 629 OR {h} = '788' THEN 'Genitourinary'"
        f" WHEN {n} BETWEEN 710 AND 739 THEN 'Musculoskeletal'"
        f" WHEN {n} BETWEEN 140 AND 239 THEN 'Neoplasms'"
        f" WHEN {n} BETWEEN 800 AND 999 THEN 'Injury' ELSE 'Other' END"
    )


def _any(low: int, high: int, symptom: str) -> str:
    tests = " OR ".join(
        f"{_number(c)} BETWEEN {low} AND {high} OR {_head(c)} = '{symptom}'"
        for c in ("diag_1", "diag_2", "diag_3")
    )
    return f"CASE WHEN {tests} THEN 1 ELSE 0 END"


DERIVED = {
    "age_category": "CASE WHEN age_midpoint < 30 THEN 'Under 30'"
    " WHEN age_midpoint BETWEEN 30 AND 64 THEN '30-64' ELSE '65 and older' END",
    "is_senior": "CASE WHEN age_midpoint >= 65 THEN 1 ELSE 0 END",
    "is_geriatric": "CASE WHEN age_midpoint >= 75 THEN 1 ELSE 0 END",
    "stay_category": "CASE WHEN time_in_hospital BETWEEN 1 AND 2 THEN 'Short'"
    " WHEN time_in_hospital BETWEEN 3 AND 6 THEN 'Medium' ELSE 'Long' END",
    "is_long_stay": "CASE WHEN time_in_hospital >= 7 THEN 1 ELSE 0 END",
    "is_short_stay": "CASE WHEN time_in_hospital <= 2 THEN 1 ELSE 0 END",
    "primary_diagnosis_group": _group("diag_1"),
    "secondary_diagnosis_group": _group("diag_2"),
    "additional_diagnosis_group": _group("diag_3"),
    "has_diabetes_diagnosis": "CASE WHEN diag_1 LIKE '250%' OR diag_2 LIKE '250%'"
    " OR diag_3 LIKE '250%' THEN 1 ELSE 0 END",
    "has_circulatory_diagnosis": _any(390, 459, "785"),
    "has_respiratory_diagnosis": _any(460, 519, "786"),
    "has_digestive_diagnosis": _any(520, 579, "787"),
    "has_genitourinary_diagnosis": _any(580, 629, "788"),
}
_IN, _EM, _OUT = (
    f"COALESCE(number_{k}, 0)" for k in ("inpatient", "emergency", "outpatient")
)
_ALL = f"({_IN} + {_EM} + {_OUT})"
DERIVED |= {
    "total_prior_visits": _ALL,
    "has_prior_inpatient": f"CASE WHEN {_IN} > 0 THEN 1 ELSE 0 END",
    "has_prior_emergency": f"CASE WHEN {_EM} > 0 THEN 1 ELSE 0 END",
    "has_prior_outpatient": f"CASE WHEN {_OUT} > 0 THEN 1 ELSE 0 END",
    "has_prior_visits": f"CASE WHEN {_ALL} > 0 THEN 1 ELSE 0 END",
    "utilization_tier": f"CASE WHEN {_ALL} = 0 THEN 'None (0 visits)'"
    f" WHEN {_ALL} BETWEEN 1 AND 2 THEN 'Low (1-2 visits)'"
    f" WHEN {_ALL} BETWEEN 3 AND 5 THEN 'Moderate (3-5 visits)' ELSE 'High (6+ visits)' END",
    "inpatient_frequency_tier": f"CASE WHEN {_IN} = 0 THEN '0 visits'"
    f" WHEN {_IN} = 1 THEN '1 visit' ELSE '2+ visits' END",
}


def _pick(columns) -> str:
    return ", ".join(f"{DERIVED[c]} AS {c}" if c in DERIVED else c for c in columns)


FEATURES = f"features AS (SELECT {_pick(S.PATIENT_FEATURE_COLUMNS)} FROM encoded)"
STEPS = {"enc": [ENC], "clean": [ENC, CLEAN], "encoded": [ENC, CLEAN, ENCODED]}
STEPS["features"] = [*STEPS["encoded"], FEATURES]


def _from(step: str, select: str, *more: str) -> str:
    return f"WITH {', '.join([*STEPS[step], *more])} {select}"


# --- predictions of the length rules -----------------------------------------------

PREDICTIONS = "pred AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS model, l.quality AS label, CAST({score} AS BIGINT) AS score,"
    f" CASE WHEN {score} >= {cut} THEN 1 ELSE 0 END AS prediction"
    f" FROM labels l JOIN documents d ON l.doc_id = d.doc_id"
    for m, (score, cut) in LENGTH_RULES.items()
) + ")"
CONFUSION = (
    "conf AS (SELECT model, count(*) AS test_rows,"
    " count(*) FILTER (label = 1 AND prediction = 1) AS tp,"
    " count(*) FILTER (label = 0 AND prediction = 0) AS tn,"
    " count(*) FILTER (label = 0 AND prediction = 1) AS fp,"
    " count(*) FILTER (label = 1 AND prediction = 0) AS fn FROM pred GROUP BY model)"
)


def _share(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / ({whole}) ELSE CAST(0 AS DOUBLE) END"


RATE_SQL = {
    "accuracy": _share("(tp + tn)", "(tp + tn + fp + fn)"),
    "precision": _share("tp", "(tp + fp)"),
    "recall": _share("tp", "(tp + fn)"),
    "f1": _share("2 * tp", "(2 * tp + fp + fn)"),
    "sensitivity": _share("tp", "(tp + fn)"),
    "specificity": _share("tn", "(tn + fp)"),
}
RATES = ", ".join(f"round({x}, 6) AS {c}" for c, x in RATE_SQL.items())


def _auc(source: str) -> str:
    """Pairs counted one by one, which the Spark side never does."""
    return (
        f"auc AS (SELECT p.model, sum(CASE WHEN p.score > n.score THEN CAST(1 AS DOUBLE)"
        f" WHEN p.score = n.score THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
        f" * p.copies * n.copies) / sum(CAST(p.copies AS DOUBLE) * n.copies) AS auc_roc"
        f" FROM (SELECT model, score, count(*) AS copies FROM {source} WHERE label = 1 GROUP BY 1, 2) p"
        f" JOIN (SELECT model, score, count(*) AS copies FROM {source} WHERE label = 0 GROUP BY 1, 2) n"
        " ON p.model = n.model GROUP BY p.model)"
    )


def _fact(place: int) -> str:
    cases = " ".join(f"WHEN '{m}' THEN {facts[place]}" for m, facts in KNOWN_FACTS.items())
    return f"CASE conf.model {cases} END"


REPORT = (
    "report AS (SELECT conf.model, CAST(" + _fact(0) + " AS BIGINT) AS train_rows, test_rows,"
    " CAST(" + _fact(1) + " AS BIGINT) AS feature_dimension, " + RATES + ","
    " round(auc.auc_roc, 6) AS auc_roc, tp, tn, fp, fn,"
    " CAST(" + _fact(2) + " AS DOUBLE) AS training_time_seconds,"
    " CAST(" + _fact(3) + " AS DOUBLE) AS prediction_time_seconds"
    " FROM conf JOIN auc ON conf.model = auc.model)"
)
REPORT_STEPS = f"WITH {PREDICTIONS}, {CONFUSION}, {_auc('pred')}, {REPORT} "

# --- scores under fixed weights ----------------------------------------------------


def _weighed(c: str, alias: str = "") -> str:
    return f"COALESCE(CAST({alias}{c} AS DOUBLE), CAST(0 AS DOUBLE)) * CAST({WEIGHTS[c]} AS DOUBLE)"


def _risk(replace: dict[str, str] | None = None) -> str:
    terms = []
    for c in WEIGHTS:
        terms.append(_weighed(c) if c not in (replace or {}) else
                     f"CAST({replace[c]} AS DOUBLE) * CAST({WEIGHTS[c]} AS DOUBLE)")
    margin = f"CAST({INTERCEPT} AS DOUBLE) + " + " + ".join(terms)
    return f"1 / (1 + exp(-({margin})))"


TIER = (
    "CASE "
    + " ".join(
        f"WHEN risk >= {start} THEN '{name}'"
        for name, start in sorted(RISK_TIER_STARTS, key=lambda s: -s[1])
    )
    + " ELSE 'Low' END"
)
COHORT_TIERS = " ".join(
    f"WHEN primary_diagnosis_group = '{cohort}' AND risk >= {start} THEN '{name}'"
    for cohort, starts in COHORT_STARTS.items()
    for name, start in sorted(starts, key=lambda s: -s[1])
) + " " + " ".join(
    f"WHEN primary_diagnosis_group = '{cohort}' THEN 'Low'" for cohort in COHORT_STARTS
)
SCORED = (
    f"risks AS (SELECT *, {_risk()} AS risk FROM features),"
    f" scored AS (SELECT *, round(risk, 6) AS risk_score,"
    f" CASE WHEN risk >= 0.5 THEN 1 ELSE 0 END AS readmission_prediction, {TIER} AS risk_tier"
    f" FROM risks)"
)
PARTS = "parts AS (" + " UNION ALL ".join(
    f"SELECT encounter_id, '{c}' AS feature, {_weighed(c)} AS contribution FROM features"
    for c in WEIGHTS
) + ")"
RANKED = (
    "ranked AS (SELECT encounter_id, feature, contribution, CAST(row_number() OVER ("
    "PARTITION BY encounter_id ORDER BY abs(contribution) DESC, feature) AS INT) AS factor_rank"
    " FROM parts)"
)
SCORE_LIST = "encounter_id, risk_score, readmission_prediction, risk_tier"
COHORT_VALUES = ", ".join(f"('{c}', '{f}', CAST({w} AS DOUBLE))" for c, f, w in COHORT_WEIGHTS)

# --- feature indexes ---------------------------------------------------------------


def _index_ctes(columns) -> list[str]:
    """Rank of every category by falling frequency, then name; and how many there are."""
    return [
        f"rank_{c} AS (SELECT value, CAST(row_number() OVER (ORDER BY copies DESC, value) - 1"
        f" AS DOUBLE) AS place FROM (SELECT CAST({c} AS VARCHAR) AS value, count(*) AS copies"
        f" FROM features WHERE {c} IS NOT NULL GROUP BY 1) counted)"
        for c in columns
    ]


def _index(c: str) -> str:
    return f"COALESCE(rank_{c}.place, (SELECT CAST(count(*) AS DOUBLE) FROM rank_{c}))"


def _index_joins(columns) -> str:
    return " ".join(
        f"LEFT JOIN rank_{c} ON CAST(features.{c} AS VARCHAR) = rank_{c}.value" for c in columns
    )


FILLED = "filled AS (SELECT encounter_id, " + ", ".join(
    f"COALESCE(CAST({c} AS DOUBLE), CAST(0 AS DOUBLE)) AS {c}" for c in S.NUMERICAL_FEATURES
) + " FROM features)"
STEP = "CAST('0x' || substr(md5(CAST(encounter_id AS VARCHAR) || ':42'), 1, 8) AS UBIGINT) % 10000"
SIDE = f"CASE WHEN {STEP} < 8000 THEN 'train' ELSE 'test' END"

VISIT_CLASS = (
    "CASE WHEN o_orderpriority = '1-URGENT' THEN 'emergency'"
    " WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'inpatient' ELSE 'outpatient' END"
)
YEAR = (
    "OVER (PARTITION BY patient_nbr ORDER BY admitted_at"
    " RANGE BETWEEN INTERVAL 365 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING)"
)

CLEAN_TABLE = _from("encoded", f"SELECT {', '.join(S.CLEAN_COLUMNS)} FROM encoded")
RAW_TABLE = _from("enc", f"SELECT {RAW} FROM enc")
FEATURE_TABLE = _from("features", f"SELECT {', '.join(S.PATIENT_FEATURE_COLUMNS)} FROM features")
TOP_FACTORS = _from(
    "features",
    "SELECT encounter_id, factor_rank, feature, round(contribution, 6) AS contribution"
    " FROM ranked WHERE factor_rank <= 3",
    PARTS,
    RANKED,
)


def _what_if(name: str, replace: dict[str, str]) -> str:
    return (
        f"SELECT encounter_id, '{name}' AS scenario, {_risk()} AS b, {_risk(replace)} AS s FROM features"
    )


# --- rules for rows and free bundles -------------------------------------------------

ROW_RULES = {
    "id_given": "encounter_id IS NOT NULL AND patient_nbr IS NOT NULL",
    "gender_known": "gender IN ('Female', 'Male')",
    "age_readable": "regexp_matches(age, '^\\[[0-9]+-[0-9]+\\)$')",
    "not_terminal": "discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21)",
    "stay_in_range": "time_in_hospital BETWEEN 1 AND 14",
    "primary_diagnosis_given": "trim(diag_1) <> '?'",
    "readmission_known": "readmitted IN ('NO', '>30', '<30')",
    "number_outpatient_given": "number_outpatient >= 0",
    "number_emergency_given": "number_emergency >= 0",
    "number_inpatient_given": "number_inpatient >= 0",
}
BROKEN_ROWS = "broken AS (SELECT encounter_id, " + ", ".join(
    f"NOT coalesce({holds}, FALSE) AS {name}" for name, holds in ROW_RULES.items()
) + " FROM enc)"
BROKEN_NAMES = "concat_ws(',', " + ", ".join(f"CASE WHEN {name} THEN '{name}' END" for name in ROW_RULES) + ")"
LISTED_RANKS = {1: "diag_1", 2: "diag_2", 3: "diag_3", 4: "diag_2", 7: "diag_1"}
LISTED = "listed AS (" + " UNION ALL ".join(
    f"SELECT 'ENC' || encounter_id AS encounter_id, CAST({rank} AS INT) AS rank, {c} AS code FROM clean WHERE {c} IS NOT NULL"
    for rank, c in LISTED_RANKS.items()
) + ")"

EMBEDDED = "(SELECT vec_id AS encounter_id FROM embeddings) embedded"
MODELS = "(VALUES ('logistic_regression'), ('random_forest'), ('decision_tree'), ('gbt')) models(model)"

ORACLES: dict[str, str] = {
    "encounters": RAW_TABLE,
    "normalized_names": RAW_TABLE,
    "clean_terminal": _from(
        "enc",
        "SELECT encounter_id, discharge_disposition_id FROM enc"
        f" WHERE discharge_disposition_id NOT IN {TERMINAL}",
    ),
    "clean_gender": _from(
        "enc",
        "SELECT encounter_id, gender FROM enc WHERE gender IS NOT NULL"
        " AND gender NOT IN ('Unknown/Invalid')",
    ),
    "clean_tokens": _from(
        "enc",
        "SELECT encounter_id, "
        + ", ".join(
            _token(c)
            for c in (
                "race", "gender", "weight", "payer_code", "medical_specialty",
                "diag_1", "diag_2", "diag_3", "max_glu_serum",
            )
        )
        + " FROM enc",
    ),
    "clean_all": _from("clean", f"SELECT {RAW} FROM clean"),
    "age_midpoint": _from("enc", f"SELECT encounter_id, age, {AGE} AS age_midpoint FROM enc"),
    "insulin_flag": _from("enc", f"SELECT encounter_id, {INSULIN} AS insulin_flag FROM enc"),
    "med_change_flag": _from(
        "enc", f"SELECT encounter_id, {CHANGE} AS medication_change_flag FROM enc"
    ),
    "diabetes_med_flag": _from(
        "enc", f"SELECT encounter_id, {MEDICATION} AS diabetes_med_flag FROM enc"
    ),
    "target": _from("enc", f"SELECT encounter_id, {TARGET} AS readmission_target FROM enc"),
    "encode_all": CLEAN_TABLE,
    "age_bins": _from(
        "encoded",
        f"SELECT {_pick(['encounter_id', 'patient_nbr', 'age', 'age_midpoint', *S.AGE_BIN_COLUMNS])}"
        " FROM encoded",
    ),
    "stay_categories": _from(
        "encoded",
        f"SELECT {_pick(['encounter_id', 'patient_nbr', 'time_in_hospital', *S.STAY_COLUMNS])}"
        " FROM encoded",
    ),
    "diagnosis_groups": _from(
        "encoded",
        "SELECT encounter_id, patient_nbr, diag_1, diag_2, diag_3,"
        f" {_pick(S.DIAGNOSIS_GROUP_COLUMNS)} FROM encoded",
    ),
    "diagnosis_flags": _from(
        "encoded", f"SELECT encounter_id, {_pick(S.DIAGNOSIS_FLAG_COLUMNS)} FROM encoded"
    ),
    "prior_admissions": _from(
        "encoded",
        f"SELECT encounter_id, patient_nbr, {_IN} AS number_inpatient, {_EM} AS number_emergency,"
        f" {_OUT} AS number_outpatient, {_pick(S.UTILIZATION_COLUMNS)} FROM encoded",
    ),
    "patient_features": FEATURE_TABLE,
    "patient_features_joined": _from(
        "encoded",
        "SELECT "
        + ", ".join(
            next(
                (
                    f"{view}.{c}"
                    for view, columns in (
                        ("a", S.AGE_BIN_COLUMNS),
                        ("s", S.STAY_COLUMNS),
                        ("g", S.DIAGNOSIS_GROUP_COLUMNS + S.DIAGNOSIS_FLAG_COLUMNS),
                        ("u", S.UTILIZATION_COLUMNS),
                    )
                    if c in columns
                ),
                f"p.{c}",
            )
            for c in S.PATIENT_FEATURE_COLUMNS
        )
        + " FROM encoded p JOIN a ON p.encounter_id = a.encounter_id"
        " JOIN s ON p.encounter_id = s.encounter_id JOIN g ON p.encounter_id = g.encounter_id"
        " JOIN u ON p.encounter_id = u.encounter_id",
        f"a AS (SELECT encounter_id, {_pick(S.AGE_BIN_COLUMNS)} FROM encoded)",
        f"s AS (SELECT encounter_id, {_pick(S.STAY_COLUMNS)} FROM encoded)",
        "g AS (SELECT encounter_id,"
        f" {_pick(S.DIAGNOSIS_GROUP_COLUMNS + S.DIAGNOSIS_FLAG_COLUMNS)} FROM encoded)",
        f"u AS (SELECT encounter_id, {_pick(S.UTILIZATION_COLUMNS)} FROM encoded)",
    ),
    "feature_view_by_name": FEATURE_TABLE,
    "diagnosis_range_join": _from(
        "encoded",
        "SELECT l.encounter_id, l.position, l.code, CASE WHEN l.code IS NULL OR trim(l.code)"
        " IN ('', '?') THEN 'Missing' ELSE COALESCE(r.diagnosis_group, 'Other') END"
        " AS diagnosis_group FROM long l LEFT JOIN ranges r"
        " ON TRY_CAST(split_part(l.code, '.', 1) AS INT) BETWEEN r.low AND r.high",
        "long AS (SELECT encounter_id, 'primary' AS position, diag_1 AS code FROM encoded"
        " UNION ALL SELECT encounter_id, 'secondary', diag_2 FROM encoded"
        " UNION ALL SELECT encounter_id, 'additional', diag_3 FROM encoded)",
        "ranges(low, high, diagnosis_group) AS (VALUES (250, 250, 'Diabetes'),"
        " (390, 459, 'Circulatory'), (785, 785, 'Circulatory'), (460, 519, 'Respiratory'),"
        " (786, 786, 'Respiratory'), (520, 579, 'Digestive'), (787, 787, 'Digestive'),"
        " (580, 629, 'Genitourinary'), (788, 788, 'Genitourinary'),"
        " (710, 739, 'Musculoskeletal'), (140, 239, 'Neoplasms'), (800, 999, 'Injury'))",
    ),
    "target_distribution": _from(
        "encoded", "SELECT readmission_target, count(*) AS rows FROM encoded GROUP BY 1"
    ),
    "age_stats": _from(
        "encoded",
        "SELECT min(age_midpoint) AS min_age, max(age_midpoint) AS max_age,"
        " count(age_midpoint) AS total_records,"
        " count(*) FILTER (age_midpoint IS NULL) AS null_ages,"
        " count(*) FILTER (age_midpoint < 0 OR age_midpoint > 120) AS out_of_range_ages"
        " FROM encoded",
    ),
    "flag_distributions": _from(
        "encoded",
        " UNION ALL ".join(
            f"SELECT '{c}' AS flag, {c} AS value, count(*) AS rows FROM encoded GROUP BY {c}"
            for c in S.FLAG_COLUMNS
        ),
    ),
    "terminal_check": _from(
        "encoded",
        f"SELECT 'raw' AS stage, count(*) FILTER (discharge_disposition_id IN {TERMINAL})"
        " AS terminal_rows FROM enc UNION ALL"
        f" SELECT 'clean', count(*) FILTER (discharge_disposition_id IN {TERMINAL}) FROM encoded",
    ),
    "clean_report": _from(
        "encoded",
        "SELECT 'PASSED' AS status, count(*) AS output_row_count,"
        " (SELECT count(*) FROM enc) AS input_row_count,"
        " (SELECT count(*) FROM enc) - count(*) AS rows_removed, "
        + ", ".join(
            f"count(*) FILTER ({c} = {v}) AS {c}_{v}"
            for c in ["readmission_target", *S.FLAG_COLUMNS]
            for v in (0, 1)
        )
        + ", min(age_midpoint) AS min_age, max(age_midpoint) AS max_age,"
        f" count(*) FILTER (discharge_disposition_id IN {TERMINAL}) AS terminal_rows,"
        " count(*) FILTER (readmission_target IS NULL) AS bad_targets,"
        " count(*) FILTER (age_midpoint IS NULL) AS null_ages,"
        " count(*) FILTER (age_midpoint NOT BETWEEN 0 AND 120) AS out_of_range_ages, "
        + ", ".join(f"count(*) FILTER ({c} IS NULL) AS bad_{c}" for c in S.FLAG_COLUMNS)
        + ", 55 AS total_columns FROM encoded",
    ),
    "key_duplicates": _from(
        "encoded",
        "SELECT patient_nbr, count(*) AS copies FROM encoded GROUP BY 1 HAVING count(*) > 1",
    ),
    "csv_roundtrip": RAW_TABLE,
    "csv_positional": RAW_TABLE,
    "parquet_roundtrip": CLEAN_TABLE,
    "clean_table": CLEAN_TABLE,
    "landing_counts": "SELECT count(*) AS landed_rows, CAST(0 AS BIGINT) AS corrupt_rows FROM orders",
    "landing_increment": _from(
        "enc",
        "SELECT CAST(1 AS INT) AS run, CAST(1 AS BIGINT) AS batch, count(*) FILTER (encounter_id % 2 = 0) AS landed_rows,"
        " CAST(0 AS BIGINT) AS corrupt_rows, count(*) FILTER (encounter_id % 2 = 0) AS readable_rows FROM enc"
        " UNION ALL SELECT 2, 2, count(*) FILTER (encounter_id % 2 = 1), 0, count(*) FROM enc"
        " UNION ALL SELECT 3, NULL, 0, 0, count(*) FROM enc",
    ),
    "rule_rejects": _from(
        "enc",
        f"SELECT encounter_id, CASE WHEN {BROKEN_NAMES} = '' THEN 'valid' ELSE 'rejected' END AS side,"
        f" {BROKEN_NAMES} AS broken_rules FROM broken",
        BROKEN_ROWS,
    ),
    "rule_counts": _from(
        "enc",
        f"SELECT 'rows' AS rule, count(*) AS n_rows FROM broken UNION ALL"
        f" SELECT 'rejected', count(*) FILTER ({BROKEN_NAMES} <> '') FROM broken UNION ALL "
        + " UNION ALL ".join(f"SELECT 'rule {name}', count(*) FILTER ({name}) FROM broken" for name in ROW_RULES),
        BROKEN_ROWS,
    ),
    "report_csv": REPORT_STEPS + "SELECT * FROM report",
    "preprocessing_job": CLEAN_TABLE,
    "confusion": f"WITH {PREDICTIONS}, {CONFUSION} SELECT * FROM conf",
    "rates": f"WITH {PREDICTIONS}, {CONFUSION} SELECT *, {RATES} FROM conf",
    "auc_exact": f"WITH {PREDICTIONS}, {_auc('pred')} SELECT model, round(auc_roc, 6) AS auc_roc FROM auc",
    "auc_encounters": _from(
        "features",
        "SELECT model, round(auc_roc, 6) AS auc_roc FROM auc",
        "pred AS (SELECT 'stay' AS model, readmission_target AS label,"
        " CAST(time_in_hospital AS BIGINT) AS score FROM features UNION ALL"
        " SELECT 'visits', readmission_target, total_prior_visits FROM features UNION ALL"
        " SELECT 'order', readmission_target, encounter_id * 7919 % 100003 FROM features)",
        # Pairs of the spread score would be too many to form: ranks, ties averaged.
        "placed AS (SELECT model, label, rank() OVER (PARTITION BY model ORDER BY score)"
        " + (count(*) OVER (PARTITION BY model, score) - 1) / CAST(2 AS DOUBLE) AS place FROM pred)",
        "auc AS (SELECT model, (sum(place) FILTER (label = 1) - CAST(count(*) FILTER (label = 1)"
        " AS DOUBLE) * (count(*) FILTER (label = 1) + 1) / 2) / (CAST(count(*) FILTER (label = 1)"
        " AS DOUBLE) * count(*) FILTER (label = 0)) AS auc_roc FROM placed GROUP BY model)",
    ),
    "metric_checks": f"WITH {PREDICTIONS}, {CONFUSION}, {_auc('pred')} SELECT conf.model,"
    " tp >= 0 AND tn >= 0 AND fp >= 0 AND fn >= 0 AS counts_ok,"
    " tp + tn + fp + fn = test_rows AS total_ok, "
    + " AND ".join(f"({x}) BETWEEN 0 AND 1" for x in RATE_SQL.values())
    + " AND auc_roc BETWEEN 0 AND 1 AS rates_ok FROM conf JOIN auc ON conf.model = auc.model",
    "model_report": REPORT_STEPS + "SELECT * FROM report",
    "champion": REPORT_STEPS
    + "SELECT * FROM report ORDER BY f1 DESC, auc_roc DESC, prediction_time_seconds, model LIMIT 1",
    "score_fixed": _from("features", f"SELECT {SCORE_LIST} FROM scored", SCORED),
    "risk_tiers": _from(
        "features",
        "SELECT risk_tier, count(*) AS encounters, CAST(sum(readmission_target) AS BIGINT)"
        " AS readmissions FROM scored GROUP BY 1",
        SCORED,
    ),
    "cohort_risk_tiers": _from(
        "features",
        f"SELECT primary_diagnosis_group, CASE {COHORT_TIERS} ELSE {TIER} END AS cohort_risk_tier,"
        " count(*) AS encounters FROM scored GROUP BY 1, 2",
        SCORED,
    ),
    "contributions": _from(
        "features",
        "SELECT encounter_id, feature, round(contribution, 6) AS contribution FROM parts",
        PARTS,
    ),
    "top_factors": TOP_FACTORS,
    "top_factors_long": TOP_FACTORS,
    "risk_percentile": _from(
        "features",
        "SELECT encounter_id, risk_score, round(percent_rank() OVER (ORDER BY risk_score), 6)"
        " AS risk_percentile FROM scored",
        SCORED,
    ),
    "what_if": _from(
        "features",
        "SELECT encounter_id, scenario, round(b, 6) AS baseline_risk, round(s, 6) AS scenario_risk,"
        " round(s - b, 6) AS risk_change FROM ("
        + _what_if(
            "stay two days shorter", {"time_in_hospital": "greatest(time_in_hospital - 2, 1)"}
        )
        + " UNION ALL "
        + _what_if("no insulin", {"insulin_flag": "0"})
        + ") both_scenarios",
    ),
    "disease_weights": _from(
        "features",
        "SELECT parts.encounter_id, primary_diagnosis_group AS cohort, parts.feature,"
        " round(contribution, 6) AS contribution,"
        " round(contribution * COALESCE(weight, 1), 6) AS weighted_contribution"
        " FROM parts JOIN features ON parts.encounter_id = features.encounter_id"
        " LEFT JOIN weights ON weights.cohort = primary_diagnosis_group"
        " AND weights.feature = parts.feature",
        PARTS,
        f"weights(cohort, feature, weight) AS (VALUES {COHORT_VALUES})",
    ),
    "patient_profile": _from(
        "features",
        "SELECT s.encounter_id, patient_nbr, age_category, stay_category,"
        " primary_diagnosis_group, utilization_tier, risk_score, risk_tier,"
        " round(lag(risk) OVER (PARTITION BY patient_nbr ORDER BY s.encounter_id), 6)"
        " AS previous_risk_score, "
        + ", ".join(f"f{i}.feature AS factor_{i}" for i in (1, 2, 3))
        + " FROM scored s "
        + " ".join(
            f"JOIN ranked f{i} ON f{i}.encounter_id = s.encounter_id AND f{i}.factor_rank = {i}"
            for i in (1, 2, 3)
        ),
        SCORED,
        PARTS,
        RANKED,
    ),
    "risk_listing": _from(
        "features",
        f"SELECT {SCORE_LIST} FROM scored WHERE risk_tier = 'High'"
        " ORDER BY encounter_id LIMIT 50 OFFSET 50",
        SCORED,
    ),
    "risk_listing_after": _from(
        "features",
        f"SELECT {SCORE_LIST} FROM scored WHERE risk_tier = 'Critical' AND encounter_id > 500"
        " ORDER BY encounter_id LIMIT 50",
        SCORED,
    ),
    "first_n": _from(
        "features",
        "SELECT encounter_id, patient_nbr, readmission_target FROM features"
        " ORDER BY encounter_id LIMIT 20",
    ),
    "cohort_rates": _from(
        "features",
        "SELECT primary_diagnosis_group, count(*) AS encounters,"
        " CAST(sum(readmission_target) AS BIGINT) AS readmissions,"
        " round(avg(readmission_target), 6) AS readmission_rate FROM features GROUP BY 1",
    ),
    "cohort_subtotals": _from(
        "features",
        "SELECT utilization_tier, age_category, count(*) AS encounters,"
        " CAST(sum(readmission_target) AS BIGINT) AS readmissions,"
        " round(avg(readmission_target), 6) AS readmission_rate FROM features"
        " GROUP BY ROLLUP (utilization_tier, age_category)",
    ),
    "comorbidity_rates": _from(
        "features",
        " UNION ALL ".join(
            f"SELECT '{c}' AS comorbidity, {c} AS present, count(*) AS encounters,"
            " round(avg(readmission_target), 6) AS readmission_rate,"
            " round(avg(total_prior_visits), 6) AS mean_prior_visits,"
            " round(CASE WHEN sum(total_prior_visits) > 0 THEN"
            " CAST(sum(COALESCE(number_inpatient, 0)) AS DOUBLE) / sum(total_prior_visits)"
            f" ELSE CAST(0 AS DOUBLE) END, 6) AS inpatient_share FROM features GROUP BY {c}"
            for c in S.DIAGNOSIS_FLAG_COLUMNS
        ),
    ),
    "prior_year_visits": "WITH visits AS (SELECT o_orderkey AS visit_id, o_custkey AS patient_nbr,"
    f" o_orderdate AS admitted_at, {VISIT_CLASS} AS visit_class FROM orders)"
    " SELECT visit_id, patient_nbr, visit_class, "
    + ", ".join(
        f"count(*) FILTER (visit_class = '{c}') {YEAR} AS prior_{c}"
        for c in ("inpatient", "emergency", "outpatient")
    )
    + f", count(*) {YEAR} AS prior_total FROM visits",
    "bundle_flatten": _from(
        "clean",
        "SELECT encounter_id, patient_nbr, time_in_hospital, diag_1, diag_2, diag_3 FROM clean",
    ),
    "bundle_conditions": _from(
        "clean",
        " UNION ALL ".join(
            f"SELECT CAST(encounter_id AS VARCHAR) || '-{i}' AS condition_id,"
            f" 'http://hl7.org/fhir/sid/icd-9-cm' AS system, diag_{i} AS code"
            f" FROM clean WHERE diag_{i} IS NOT NULL"
            for i in (1, 2, 3)
        ),
    ),
    "catalog_views": FEATURE_TABLE,
    "catalog_functions": _from(
        "features",
        "SELECT encounter_id, age_category, stay_category, primary_diagnosis_group, inpatient_frequency_tier FROM features",
    ),
    "sketch_percentiles": "WITH visits AS (SELECT o_orderpriority AS cohort, CAST(trunc(o_totalprice) AS BIGINT) AS measure"
    " FROM orders) SELECT cohort, count(*) AS n_rows, count(measure) AS n_values, min(measure) AS least,"
    " max(measure) AS greatest, TRUE AS p50_within, TRUE AS p90_within, TRUE AS persons_within FROM visits GROUP BY cohort",
    "bundle_codings": _from(
        "clean",
        "SELECT encounter_id, rank, 'http://hl7.org/fhir/sid/icd-9-cm' AS system, code FROM listed"
        " UNION ALL SELECT encounter_id, rank, 'urn:codes:spelled', 'code ' || code FROM listed",
        LISTED,
    ),
    "bundle_ranks": _from(
        "clean",
        "SELECT rank, count(*) AS n_encounters, count(DISTINCT code) AS n_codes FROM listed GROUP BY rank",
        LISTED,
    ),
    "bundle_text_ids": _from(
        "clean",
        "SELECT 'ENC' || encounter_id AS encounter_id, 'PAT' || patient_nbr AS patient_nbr, time_in_hospital,"
        " diag_1, diag_2, diag_3, row_number() OVER (ORDER BY encounter_id % 2, 'ENC' || encounter_id) AS encounter_number"
        " FROM clean",
    ),
    "bundle_rejects": _from(
        "clean",
        "SELECT 'reject' AS what, CASE encounter_id % 10 WHEN 0 THEN 'null' WHEN 1 THEN 'not_json' WHEN 2 THEN"
        " 'not_a_bundle' WHEN 3 THEN 'no_entries' WHEN 4 THEN 'no_resource' ELSE 'encounter_without_id' END AS name,"
        " count(*) AS n_rows FROM clean WHERE encounter_id % 10 < 6 GROUP BY 2 UNION ALL"
        " SELECT 'resource', 'Encounter', count(*) FROM clean WHERE encounter_id % 10 > 5 UNION ALL"
        " SELECT 'resource', 'Condition', count(diag_1) + count(diag_2) + count(diag_3) FROM clean WHERE encounter_id % 10 > 5",
    ),
    "event_properties": "WITH read AS (SELECT event_type,"
    " TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)"
    " SELECT event_type, count(*) AS events, count(k) AS with_k, CAST(sum(k) AS BIGINT) AS sum_k,"
    " max(k) AS max_k FROM read GROUP BY 1",
    "string_index": _from(
        "features",
        "SELECT encounter_id, "
        + ", ".join(f"{_index(c)} AS {c}_indexed" for c in S.CATEGORICAL_FEATURES)
        + f" FROM features {_index_joins(S.CATEGORICAL_FEATURES)}",
        *_index_ctes(S.CATEGORICAL_FEATURES),
    ),
    "one_hot_long": _from(
        "features",
        " UNION ALL ".join(
            f"SELECT encounter_id, '{c}' AS feature, CAST({_index(c)} AS BIGINT) AS position,"
            f" CAST((SELECT count(*) FROM rank_{c}) + 2 AS INT) AS size"
            f" FROM features {_index_joins([c])}"
            for c in ONE_HOT
        ),
        *_index_ctes(ONE_HOT),
    ),
    "numeric_fill": _from(
        "features", f"SELECT encounter_id, {', '.join(S.NUMERICAL_FEATURES)} FROM filled", FILLED
    ),
    "scaled_numerics": _from(
        "features",
        "SELECT encounter_id, "
        + ", ".join(
            f"round(CASE WHEN stddev_samp({c}) OVER () = 0 THEN CAST(0 AS DOUBLE)"
            f" ELSE {c} / stddev_samp({c}) OVER () END, 6) AS {c}"
            for c in S.NUMERICAL_FEATURES
        )
        + " FROM filled",
        FILLED,
    ),
    "model_reload": f"SELECT count(*) AS rows, CAST(0 AS BIGINT) AS different FROM {EMBEDDED} WHERE {SIDE} = 'test'",
    "report_contract": "SELECT model, train_rows, test_rows, TRUE AS all_counted, TRUE AS rates_bounded FROM (SELECT"
    f" count(*) FILTER ({SIDE} = 'train') AS train_rows, count(*) FILTER ({SIDE} = 'test') AS test_rows FROM {EMBEDDED}),"
    f" {MODELS}",
    "prediction_contract": _from(
        "features",
        f"SELECT model, encounter_id, TRUE AS bounded, TRUE AS decided FROM features, {MODELS} WHERE {SIDE} = 'test'",
    ),
    "regression_gradient": _from(
        "features", f"SELECT count(*) AS train_rows, CAST(0 AS BIGINT) AS steep_slots FROM features WHERE {SIDE} = 'train'"
    ),
    "fold_sizes": _from(
        "features",
        "SELECT CAST(floor((bits % 10000 + floor(bits / 10000) / CAST(429497 AS DOUBLE)) / 10000 * 3) AS INT) AS fold,"
        " count(*) AS n_rows FROM (SELECT CAST('0x' || substr(md5(CAST(encounter_id AS VARCHAR) || ':42'), 1, 8) AS BIGINT)"
        " AS bits FROM features) GROUP BY 1",
    ),
    "hash_split": _from("features", f"SELECT encounter_id, {SIDE} AS side FROM features"),
    "split_counts": _from(
        "features", f"SELECT {SIDE} AS side, count(*) AS rows FROM features GROUP BY 1"
    ),
}

LONG_CODES = (
    "long AS (SELECT encounter_id, 'primary' AS position, diag_1 AS code FROM encoded"
    " UNION ALL SELECT encounter_id, 'secondary', diag_2 FROM encoded"
    " UNION ALL SELECT encounter_id, 'additional', diag_3 FROM encoded)"
)


def _code_text(c: str) -> str:
    """A code without its dot, numbers before it with three digits, as text that sorts."""
    head, tail = f"split_part(upper(trim({c})), '.', 1)", f"regexp_extract(upper(trim({c})), '\\.(.*)$', 1)"
    text = f"(CASE WHEN regexp_full_match({head}, '\\d{{1,2}}') THEN lpad({head}, 3, '0') ELSE {head} END || replace({tail}, '.', ''))"
    return f"CASE WHEN regexp_full_match({text}, '[0-9A-Z]{{1,7}}') THEN {text} END"


WIDE_TEXT = {"o_custkey": "CAST(o_custkey AS VARCHAR)", "o_orderdate": "strftime(o_orderdate, '%Y-%m-%d')",
             "o_totalprice": "printf('%.2f', o_totalprice)"}
ORACLES |= {
    "batch_score_job": _from(
        "features",
        f"SELECT {SCORE_LIST}, CAST(1 AS BIGINT) AS model_version, score_date FROM scored,"
        f" (VALUES {', '.join(f"('{day}')" for day in SCORE_DAYS)}) days(score_date)",
        SCORED,
    ),
    "tree_contributions": _from(
        "features",
        f"SELECT model, count(*) AS rows, CAST(0 AS BIGINT) AS wrong_rows FROM features,"
        f" (VALUES ('decision_tree'), ('gbt')) m(model) WHERE {SIDE} = 'test' GROUP BY 1",
    ),
    "category_index": ORACLES["string_index"],
    "category_index_wide": "WITH features AS (SELECT o_orderkey, "
    + ", ".join(f"{text} AS {c}" for c, text in WIDE_TEXT.items())
    + " FROM orders), "
    + ", ".join(_index_ctes(WIDE_COLUMNS))
    + " SELECT o_orderkey, "
    + ", ".join(f"{_index(c)} AS {c}_indexed" for c in WIDE_COLUMNS)
    + f" FROM features {_index_joins(WIDE_COLUMNS)}",
    "interval_join": _from(
        "encoded",
        "SELECT l.encounter_id, l.position, l.code, r.diagnosis_group FROM placed l LEFT JOIN"
        " (SELECT DISTINCT p.code, g.diagnosis_group FROM placed p JOIN bounds g ON rpad(p.text, 7, '0') BETWEEN g.low AND g.high) r"
        " ON l.code = r.code",
        LONG_CODES,
        f"placed AS (SELECT *, {_code_text('code')} AS text FROM long)",
        f"ranges(low, high, diagnosis_group) AS (VALUES {', '.join(map(repr, CODE_RANGES))})",
        f"bounds AS (SELECT rpad({_code_text('low')}, 7, '0') AS low, rpad({_code_text('high')}, 7, 'Z') AS high,"
        " diagnosis_group FROM ranges)",
    ),
}

POINTS = (
    "counts AS (SELECT model, CAST(score AS DOUBLE) AS threshold, count(*) FILTER (label = 1) AS pos,"
    " count(*) FILTER (label = 0) AS neg FROM pred GROUP BY 1, 2),"
    " points AS (SELECT model, threshold, CAST(sum(pos) OVER above AS BIGINT) AS tp, CAST(sum(neg) OVER above AS BIGINT) AS fp,"
    " CAST(sum(pos) OVER (PARTITION BY model) - sum(pos) OVER above AS BIGINT) AS fn,"
    " CAST(sum(neg) OVER (PARTITION BY model) - sum(neg) OVER above AS BIGINT) AS tn FROM counts"
    " WINDOW above AS (PARTITION BY model ORDER BY threshold DESC))"
)
_SHARE = "CASE WHEN {b} > 0 THEN CAST({a} AS DOUBLE) / ({b}) ELSE CAST(0 AS DOUBLE) END"
ORACLES |= {
    "roc_points": f"WITH {PREDICTIONS}, {POINTS} SELECT *,"
    f" round({_SHARE.format(a='tp', b='tp + fn')}, 6) AS true_positive_rate,"
    f" round({_SHARE.format(a='fp', b='fp + tn')}, 6) AS false_positive_rate,"
    f" round({_SHARE.format(a='tp', b='tp + fp')}, 6) AS precision FROM points",
    "threshold_choice": f"WITH {PREDICTIONS}, {POINTS}, priced AS (SELECT *, CAST(fp + 5 * fn AS DOUBLE) AS cost,"
    " row_number() OVER (PARTITION BY model ORDER BY fp + 5 * fn, threshold DESC) AS place FROM points)"
    " SELECT model, threshold, cost, tp, fp, fn, tn FROM priced WHERE place = 1",
}
