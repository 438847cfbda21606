import os

import pytest

os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 4g pyspark-shell")

from sitelode.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate a one-argument column function over a list of strings."""
    from pyspark.sql import functions as F

    def run(function, inputs):
        rows = spark.createDataFrame(list(enumerate(inputs)), "n int, x string")
        return [r.y for r in rows.select("n", function(F.col("x")).alias("y")).orderBy("n").collect()]

    return run


def page(url, body, status=200, content_type="text/html", location=None, elapsed_ms=100):
    return (url, status, content_type, body, location, elapsed_ms)
