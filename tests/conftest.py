import pytest

from ordermill.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session(
        "ordermill-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__default__parallelism="2",
        spark__sql__warehouse__dir=str(home / "warehouse"),
        spark__checkpoint__dir=str(home / "checkpoint"),
        spark__ui__enabled="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
