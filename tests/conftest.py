import pytest

from tests.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture()
def rows(spark):
    """Make a DataFrame from a schema and rows."""
    return lambda schema, data: spark.createDataFrame(data, schema)


def by_key(df, key=0):
    return {row[key]: tuple(row) for row in df.collect()}
