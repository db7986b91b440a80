import pytest

from tradewind import build_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""
    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(row) for row in df.collect()), key=lambda row: tuple((v is not None, v) for v in row))
    return collect


@pytest.fixture
def many_ranges(spark):
    """Small shuffles keep all their partitions, so that ranged code sees several ranges."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")
