import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from rostrum.session import session

    s = session("tests", spark__master="local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g", spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tiny():
    folder = DATA / "sf0.001"
    if not folder.exists():
        pytest.skip("no test tables here")
    return str(folder)


@pytest.fixture(scope="session")
def small():
    folder = DATA / "sf0.01"
    if not folder.exists():
        pytest.skip("no test tables here")
    return str(folder)
