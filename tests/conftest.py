import pytest

from phasemill.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, "4g")
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    yield session
    session.stop()
