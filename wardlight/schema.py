"""Column names and types, the one place they are stated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The 23 diabetes drugs, spelled as in the raw file's header.
DRUG_HEADERS = [
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride",
    "acetohexamide", "glipizide", "glyburide", "tolbutamide", "pioglitazone",
    "rosiglitazone", "acarbose", "miglitol", "troglitazone", "tolazamide",
    "examide", "citoglipton", "insulin", "glyburide-metformin",
    "glipizide-metformin", "glimepiride-pioglitazone",
    "metformin-rosiglitazone", "metformin-pioglitazone",
]

# The raw file's 50 columns in file order.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("encounter_id", T.LongType()),
        T.StructField("patient_nbr", T.LongType()),
        T.StructField("race", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("age", T.StringType()),
        T.StructField("weight", T.StringType()),
        T.StructField("admission_type_id", T.IntegerType()),
        T.StructField("discharge_disposition_id", T.IntegerType()),
        T.StructField("admission_source_id", T.IntegerType()),
        T.StructField("time_in_hospital", T.IntegerType()),
        T.StructField("payer_code", T.StringType()),
        T.StructField("medical_specialty", T.StringType()),
        T.StructField("num_lab_procedures", T.IntegerType()),
        T.StructField("num_procedures", T.IntegerType()),
        T.StructField("num_medications", T.IntegerType()),
        T.StructField("number_outpatient", T.IntegerType()),
        T.StructField("number_emergency", T.IntegerType()),
        T.StructField("number_inpatient", T.IntegerType()),
        T.StructField("diag_1", T.StringType()),
        T.StructField("diag_2", T.StringType()),
        T.StructField("diag_3", T.StringType()),
        T.StructField("number_diagnoses", T.IntegerType()),
        T.StructField("max_glu_serum", T.StringType()),
        T.StructField("A1Cresult", T.StringType()),
        *[T.StructField(drug, T.StringType()) for drug in DRUG_HEADERS],
        T.StructField("change", T.StringType()),
        T.StructField("diabetesMed", T.StringType()),
        T.StructField("readmitted", T.StringType()),
    ]
)


def normalize_name(name: str) -> str:
    """Lower case, with underscores for hyphens."""
    return name.lower().replace("-", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column to its normalized name."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


def raw_header_columns(df: DataFrame) -> DataFrame:
    """The inverse of ``normalize_columns`` for a frame of raw encounters."""
    spelled = {normalize_name(f.name): f.name for f in RAW_SCHEMA}
    return df.withColumnsRenamed({c: spelled.get(normalize_name(c), c) for c in df.columns})


ENCOUNTER_SCHEMA = T.StructType(
    [T.StructField(normalize_name(f.name), f.dataType) for f in RAW_SCHEMA]
)
RAW_COLUMNS = ENCOUNTER_SCHEMA.fieldNames()

FLAG_COLUMNS = ["insulin_flag", "medication_change_flag", "diabetes_med_flag"]
TARGET_COLUMN = "readmission_target"
ENCODED_COLUMNS = ["age_midpoint", *FLAG_COLUMNS, TARGET_COLUMN]

CLEAN_SCHEMA = T.StructType(
    [*ENCOUNTER_SCHEMA, *[T.StructField(c, T.IntegerType()) for c in ENCODED_COLUMNS]]
)
CLEAN_COLUMNS = CLEAN_SCHEMA.fieldNames()

DRUG_COLUMNS = [normalize_name(d) for d in DRUG_HEADERS]
STRING_COLUMNS = [f.name for f in ENCOUNTER_SCHEMA if isinstance(f.dataType, T.StringType)]

AGE_BIN_COLUMNS = ["age_category", "is_senior", "is_geriatric"]
STAY_COLUMNS = ["stay_category", "is_long_stay", "is_short_stay"]
UTILIZATION_COLUMNS = [
    "total_prior_visits", "has_prior_inpatient", "has_prior_emergency",
    "has_prior_outpatient", "has_prior_visits", "utilization_tier",
    "inpatient_frequency_tier",
]
DIAGNOSIS_GROUP_COLUMNS = [
    "primary_diagnosis_group", "secondary_diagnosis_group", "additional_diagnosis_group",
]
DIAGNOSIS_FLAG_COLUMNS = [
    "has_diabetes_diagnosis", "has_circulatory_diagnosis", "has_respiratory_diagnosis",
    "has_digestive_diagnosis", "has_genitourinary_diagnosis",
]

# Column order of the 75-column patient feature table.
PATIENT_FEATURE_COLUMNS = [
    "encounter_id", "patient_nbr", "race", "gender", "age", "age_midpoint",
    *AGE_BIN_COLUMNS,
    "admission_type_id", "discharge_disposition_id", "admission_source_id",
    "time_in_hospital", *STAY_COLUMNS,
    "payer_code", "medical_specialty", "num_lab_procedures", "num_procedures",
    "num_medications", "number_diagnoses", "max_glu_serum", "a1cresult",
    "number_outpatient", "number_emergency", "number_inpatient",
    *UTILIZATION_COLUMNS,
    "diag_1", "diag_2", "diag_3", *DIAGNOSIS_GROUP_COLUMNS, *DIAGNOSIS_FLAG_COLUMNS,
    *DRUG_COLUMNS,
    "change", "diabetesmed", *FLAG_COLUMNS, "readmitted", TARGET_COLUMN,
]

# What the models are fitted on, in vector order.
CATEGORICAL_FEATURES = [
    "race", "gender", "age_category",
    "admission_type_id", "discharge_disposition_id", "admission_source_id",
    "stay_category", "payer_code", "medical_specialty",
    "max_glu_serum", "a1cresult",
    *DIAGNOSIS_GROUP_COLUMNS,
    "utilization_tier", "inpatient_frequency_tier",
    *DRUG_COLUMNS,
    "change", "diabetesmed",
]
NUMERICAL_FEATURES = [
    "age_midpoint", "time_in_hospital", "num_lab_procedures", "num_procedures",
    "num_medications", "number_diagnoses",
    "number_outpatient", "number_emergency", "number_inpatient", "total_prior_visits",
    "has_prior_inpatient", "has_prior_emergency", "has_prior_outpatient", "has_prior_visits",
    "is_senior", "is_geriatric", "is_long_stay", "is_short_stay",
    *DIAGNOSIS_FLAG_COLUMNS,
    *FLAG_COLUMNS,
]
FEATURE_COLUMNS = CATEGORICAL_FEATURES + NUMERICAL_FEATURES

# Identifiers, the target in both forms, and superseded raw fields.
EXCLUDED_COLUMNS = [
    "encounter_id", "patient_nbr", TARGET_COLUMN, "readmitted", "weight",
    "diag_1", "diag_2", "diag_3", "age",
]
