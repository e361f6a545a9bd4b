import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from claimlens import Tables, configure, schemas  # noqa: E402
from helpers import frame  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        configure(SparkSession.builder.master("local[8]").appName("claimlens-tests"), 4)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def make(spark):
    """Tables from lists of dicts; tables that are not given are empty."""

    def build(**given):
        return Tables({name: frame(spark, s, given.get(name, [])) for name, s in schemas.TABLES.items()})

    return build
