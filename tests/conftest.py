import pytest

from campusloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session("8", partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
