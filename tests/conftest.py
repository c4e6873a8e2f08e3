import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("finchlake-tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def apply(spark):
    """Run a Column function over literal texts and return the results in order."""
    from pyspark.sql import functions as F

    def run(fn, values, kind="string"):
        rows = spark.createDataFrame(list(enumerate(values)), f"id int, x {kind}")
        return [r[0] for r in rows.orderBy("id").select(fn(F.col("x"))).collect()]

    return run
