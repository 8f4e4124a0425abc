import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Executor-side Python workers import the package too.
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

from lawloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    base = tempfile.mkdtemp(prefix="lawloom-test-")
    session = build_session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__sql__warehouse__dir=f"{base}/warehouse",
        spark__checkpoint__dir=f"{base}/checkpoint",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
