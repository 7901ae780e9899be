import pytest

from corpusmill.session import session


@pytest.fixture(scope="session")
def spark():
    s = session(
        "tests",
        spark__master="local[8]",
        spark__driver__memory="6g",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
    )
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture
def one(spark):
    """Evaluates columns over one row of named values."""

    def run(columns, **values):
        from pyspark.sql import functions as F

        row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
        return row.select(*columns).first()

    return run
