import pytest

from kinfold.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "kinfold-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows of tuples as a DataFrame."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make
