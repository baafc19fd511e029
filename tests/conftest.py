import pytest

from runlens.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, partitions=4, app="runlens-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_chunks(monkeypatch):
    """Cut every ordered key into chunks of three rows, so that chunk borders matter."""
    monkeypatch.setattr("runlens.operators.ordered.CHUNK_ROWS", 3)


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())
