import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from featureflow.session import build_session

# A failing row surfaces as either, depending on where Spark meets it.
SPARK_ERRORS = (PySparkException, Py4JJavaError)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SMALL_SF_DIR = os.environ.get("TEST_SMALL_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    """Rows as a sorted list of tuples, nulls first."""
    return sorted(
        (tuple(r) for r in df.collect()), key=lambda t: tuple((v is not None, str(type(v)), v) for v in t)
    )
