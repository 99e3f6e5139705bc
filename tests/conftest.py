import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from leadchecks.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores="4")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Value of a column expression on one text."""
    from pyspark.sql import functions as F

    def value(function, text):
        df = spark.createDataFrame([(text,)], "t string")
        return df.select(function(F.col("t")).alias("v")).first()["v"]

    return value


@pytest.fixture(scope="session")
def many(spark):
    """Values of a column expression on many texts, in their order."""
    from pyspark.sql import functions as F

    def values(function, texts):
        df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
        rows = df.select("i", function(F.col("t")).alias("v")).collect()
        return [r["v"] for r in sorted(rows, key=lambda r: r["i"])]

    return values


@pytest.fixture(scope="session")
def plan_of():
    """Physical plan of a DataFrame as text."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
