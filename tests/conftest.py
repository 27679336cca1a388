import pytest

from marketloom.session import build_session


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", 4, spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false", spark__sql__autoBroadcastJoinThreshold="1m")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
