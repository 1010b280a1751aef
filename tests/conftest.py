import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("recordloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="recordloom-test-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows_of():
    """Rows as sorted tuples of the named columns."""

    def rows(df, *columns):
        names = columns or df.columns
        return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)

    return rows


@pytest.fixture
def records(spark):
    """DataFrame from JSON texts, with the schema Spark infers or the one given."""

    def make(*texts, schema=None):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(t,) for t in texts], "body string")
        if schema is None:
            v = df.select(F.parse_json("body").alias("record"))
            from recordloom.sources import infer_schema

            schema = infer_schema(v)
        return df.select(F.from_json("body", schema).alias("r")).select("r.*")

    return make
