import pytest

from roadpulse.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", spark__driver__memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
