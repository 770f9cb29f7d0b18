import pytest

from corpusloom.runtime import local_session, ship


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8)
    ship(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """A frame of (ord, text) from a list of texts."""
    return lambda texts: spark.createDataFrame(list(enumerate(texts)), "ord long, text string")
