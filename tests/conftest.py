import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarrystone.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
#: Column expressions at the top of test modules need a session when they are collected.
SESSION = build_session(
    "tests",
    "local[4]",
    spark__driver__memory="4g",
    spark__sql__shuffle__partitions="4",
    spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="tests-warehouse-"),
    spark__ui__showConsoleProgress="false",
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("the driver's tables are not here")
    return SMALL
