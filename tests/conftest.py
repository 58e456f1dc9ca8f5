import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tenderlens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.maxMetadataStringLength", "5000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture
def one_column(spark):
    """Values of an expression over one column of inputs, in input order."""

    def run(values, kind, expression):
        from pyspark.sql import functions as F

        table = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
        return [r[0] for r in table.orderBy("i").select(expression(F.col("x"))).collect()]

    return run
