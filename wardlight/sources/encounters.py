"""An encounter table read off an orders table: one order plays one encounter.

The column formulas are integer arithmetic on the order and customer keys, so the
table grows with ``orders`` and any SQL engine computes the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardlight import schema as S
from wardlight.session import deal_rows

KEY_FORMULA = "o_orderkey * 7919 + o_custkey * 104729"


def _drug(i: int) -> str:
    return f"CASE (K + 13*{i}) % 5 WHEN 0 THEN 'Steady' WHEN 1 THEN 'Up' WHEN 2 THEN 'Down' ELSE 'No' END"


def _diagnosis(j: int) -> str:
    k = f"(K + 31*{j})"
    return (
        f"CASE {k} % 13 WHEN 0 THEN '?' WHEN 1 THEN NULL"
        f" WHEN 2 THEN '250.' || CAST({k} % 94 AS VARCHAR(5))"
        f" WHEN 3 THEN CAST(390 + {k} % 70 AS VARCHAR(5))"
        f" WHEN 4 THEN CAST(460 + {k} % 60 AS VARCHAR(5)) || '.1'"
        f" WHEN 5 THEN CAST(520 + {k} % 60 AS VARCHAR(5))"
        " WHEN 6 THEN '785' WHEN 7 THEN '786.5' WHEN 8 THEN 'V57' WHEN 9 THEN 'E909'"
        f" WHEN 10 THEN CAST(140 + {k} % 100 AS VARCHAR(5))"
        f" WHEN 11 THEN CAST(800 + {k} % 200 AS VARCHAR(5))"
        f" ELSE CAST(580 + {k} % 170 AS VARCHAR(5)) END"
    )


def _decade(step: int) -> str:
    return f"CAST(((K % 101) % 10 + {step}) * 10 AS VARCHAR(5))"


_FORMULAS = {
    "encounter_id": "o_orderkey",
    "patient_nbr": "o_custkey",
    "race": "CASE K % 6 WHEN 0 THEN '?' WHEN 1 THEN 'AfricanAmerican' WHEN 2 THEN 'Hispanic'"
    " WHEN 3 THEN ' ? ' ELSE 'Caucasian' END",
    "gender": "CASE WHEN K % 50 = 0 THEN 'Unknown/Invalid' WHEN K % 50 = 1 THEN NULL"
    " WHEN K % 2 = 0 THEN 'Female' ELSE 'Male' END",
    "age": f"'[' || {_decade(0)} || '-' || {_decade(1)} || ')'",
    "weight": "'?'",
    "admission_type_id": "CAST(1 + K % 8 AS INT)",
    "discharge_disposition_id": "CAST(1 + K % 29 AS INT)",
    "admission_source_id": "CAST(1 + K % 17 AS INT)",
    "time_in_hospital": "CAST(1 + K % 14 AS INT)",
    "payer_code": "CASE K % 5 WHEN 0 THEN '?' WHEN 1 THEN 'MC' WHEN 2 THEN 'HM'"
    " WHEN 3 THEN 'SP' ELSE 'BC' END",
    "medical_specialty": "CASE K % 7 WHEN 0 THEN 'Cardiology' WHEN 1 THEN 'InternalMedicine'"
    " WHEN 2 THEN 'Surgery-General' ELSE '?' END",
    "num_lab_procedures": "CAST(1 + K % 113 AS INT)",
    "num_procedures": "CAST((K % 31) % 7 AS INT)",
    "num_medications": "CAST(1 + K % 61 AS INT)",
    "number_outpatient": "CASE WHEN K % 5 = 0 THEN CAST(K % 11 AS INT) ELSE 0 END",
    "number_emergency": "CASE WHEN K % 4 = 0 THEN CAST(K % 5 AS INT) ELSE 0 END",
    "number_inpatient": "CASE WHEN K % 97 = 0 THEN NULL WHEN K % 3 = 0 THEN CAST(K % 7 AS INT)"
    " ELSE 0 END",
    "diag_1": _diagnosis(1),
    "diag_2": _diagnosis(2),
    "diag_3": _diagnosis(3),
    "number_diagnoses": "CAST(1 + K % 16 AS INT)",
    "max_glu_serum": "CASE K % 19 WHEN 0 THEN '>300' WHEN 1 THEN '>200' WHEN 2 THEN 'Norm'"
    " ELSE 'None' END",
    "a1cresult": "CASE K % 23 WHEN 0 THEN '>8' WHEN 1 THEN '>7' WHEN 2 THEN 'Norm'"
    " ELSE 'None' END",
    **{drug: _drug(i) for i, drug in enumerate(S.DRUG_COLUMNS)},
    "examide": "'No'",
    "citoglipton": "'No'",
    "change": "CASE WHEN K % 3 = 0 THEN 'Ch' ELSE 'No' END",
    "diabetesmed": "CASE WHEN K % 10 < 7 THEN 'Yes' ELSE 'No' END",
    "readmitted": "CASE (K % 103) % 9 WHEN 0 THEN '<30' WHEN 1 THEN '>30' WHEN 2 THEN '>30'"
    " ELSE 'NO' END",
}


def encounter_sql(orders: str = "orders") -> str:
    """The derivation as one SELECT over an orders table."""
    columns = ",\n  ".join(f"{_FORMULAS[c]} AS {c}" for c in S.RAW_COLUMNS)
    return f"SELECT\n  {columns}\nFROM (SELECT *, {KEY_FORMULA} AS K FROM {orders}) keyed"


def encounters_from_orders(orders: DataFrame) -> DataFrame:
    keyed = orders.selectExpr("o_orderkey", "o_custkey", f"{KEY_FORMULA} AS K")
    return keyed.selectExpr(*[f"{_FORMULAS[c]} AS {c}" for c in S.RAW_COLUMNS])


def read_encounters(spark: SparkSession, data_dir: str) -> DataFrame:
    """Encounters dealt by their number: a few packed bytes of keys become fifty columns, so tasks
    cut by the size of the file would be few and large."""
    orders = spark.read.parquet(f"{data_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    return encounters_from_orders(deal_rows(orders))
