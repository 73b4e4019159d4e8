import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = ROOT
