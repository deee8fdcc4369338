import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewell.session import build_session, new_workspace  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", master="local[8]", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def workspace(spark):
    return new_workspace(spark, "test")


@pytest.fixture(scope="session")
def evaluate(spark):
    """Value of an expression over one row of named values."""

    def run(expression, **values):
        def literal(v):
            if v is None:
                return "cast(null as double)"
            return f"{float(v)!r}D"

        row = ", ".join(f"{literal(v)} as {k}" for k, v in values.items())
        return spark.sql(f"select {expression} as x from (select {row})").first()["x"]

    return run
