import pytest

from ledgerwake.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "ledgerwake-tests", master="local[8]", shuffle_partitions=8,
        spark__ui__enabled="false", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
