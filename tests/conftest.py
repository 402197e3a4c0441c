import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabloom.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.log.level": "ERROR",
    })
    yield session
    session.stop()


@pytest.fixture
def partitions(spark):
    """Set the number of shuffle partitions for one test."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield lambda n: spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.shuffle.partitions", before)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
