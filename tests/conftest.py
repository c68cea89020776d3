import pytest

from asphalt.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()
