import pytest

from tallyloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, shuffle_partitions=4, spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples, nulls first."""
    def sort(df, *cols):
        found = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
        return sorted(found, key=lambda r: tuple((v is not None, str(type(v)) if isinstance(v, str) else "", v if v is not None else 0) for v in r))
    return sort
