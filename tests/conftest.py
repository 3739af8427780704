import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pagemill.session import build_session

    session = build_session(
        "pagemill-tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of an expression over one text column `s`."""

    def run(value, column):
        return spark.createDataFrame([(value,)], "s string").select(column.alias("v")).first()["v"]

    return run
