import pytest

from voltmesh.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", cpus="8", spark__sql__shuffle__partitions="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
