import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pulsegrid.session import build_session  # noqa: E402

DATA = os.environ.get("PULSEGRID_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="3g", spark__sql__autoBroadcastJoinThreshold="1m"
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    return DATA
