"""The rules and views as lasting objects of Spark's catalog, for users of SQL.

Their text is taken from the same columns that the DataFrame form is built of: each is resolved
over an empty frame and written as SQL, so a rule is stated once. A view names its table and
holds no path or session, and any later session of the catalog can read it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight import schema as S
from wardlight.functions import clinical as fn
from wardlight.operators import views


def _group(code: Column) -> Column:
    head = fn.code_head(code)
    return fn.diagnosis_group(code, head, fn.code_number(head))


#: Name: the parameters with their types, and the rule over columns of these names.
FUNCTIONS: dict[str, tuple[str, Callable[..., Column]]] = {
    "age_midpoint": ("age string", fn.age_midpoint),
    "age_category": ("midpoint int", fn.age_category),
    "stay_category": ("days int", fn.stay_category),
    "readmission_target": ("readmitted string", fn.readmission_target),
    "diagnosis_group": ("code string", _group),
    "is_diabetes_code": ("code string", fn.is_diabetes_code),
    "utilization_tier": ("visits int", fn.utilization_tier),
    "inpatient_frequency_tier": ("stays int", fn.inpatient_frequency_tier),
    "risk_tier": ("probability double", fn.risk_tier),
}


def select_text(df: DataFrame, source: str) -> str:
    """The projections of a frame as nested SELECTs over ``source``."""
    plan, levels = df._jdf.queryExecution().analyzed(), []
    while plan.nodeName() == "Project":
        items = plan.projectList()
        levels.append([items.apply(i).sql() for i in range(items.size())])
        plan = plan.child()
    if plan.children().size():
        raise ValueError(f"only projections can be written: found {plan.nodeName()}")
    for depth, items in enumerate(reversed(levels)):
        source = f"SELECT {', '.join(items)} FROM {f'({source})' if depth else source}"
    return source


def create_functions(
    spark: SparkSession,
    database: str = "default",
    functions: Mapping[str, tuple[str, Callable[..., Column]]] = FUNCTIONS,
) -> list[str]:
    """Create or replace SQL functions for the rules; their full names."""
    made = []
    for name, (parameters, rule) in functions.items():
        given = spark.createDataFrame([], parameters)
        result = given.select(rule(*[F.col(c) for c in given.columns]).alias("result"))
        body = result._jdf.queryExecution().analyzed().projectList().apply(0).child().sql()
        kind = result.schema[0].dataType.simpleString()
        spark.sql(f"CREATE OR REPLACE FUNCTION {database}.{name}({parameters}) RETURNS {kind} RETURN {body}")
        made.append(f"{database}.{name}")
    return made


def create_views(
    spark: SparkSession,
    table: str,
    database: str = "default",
    builders: Mapping[str, Callable[[DataFrame], DataFrame]] = views.VIEWS,
) -> list[str]:
    """Create or replace the feature views over a catalog table of clean encounters; their full
    names. Filters and columns of a query on them reach the table's files."""
    empty = spark.createDataFrame([], S.CLEAN_SCHEMA)
    for name, build in builders.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {select_text(build(empty), table)}")
    return [f"{database}.{name}" for name in builders]
