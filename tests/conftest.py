import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wardlight.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": "3000",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def clean(spark, tiny):
    from wardlight.plans.jobs import clean_and_encode
    from wardlight.session import materialize
    from wardlight.sources.encounters import read_encounters

    return materialize(clean_and_encode(read_encounters(spark, tiny)), "clean")


@pytest.fixture(scope="session")
def features(clean):
    from wardlight.operators.views import patient_features
    from wardlight.session import materialize

    return materialize(patient_features(clean), "features")


@pytest.fixture
def plan():
    """Physical plan as text."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
