import os
import sys

import pytest
from pyspark.sql import Row

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from binledger.llm.registry import ship  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def frame(spark):
    """Rows and a DDL schema to a DataFrame."""
    return lambda rows, ddl: spark.createDataFrame([Row(*r) for r in rows], ddl)
