import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TESTS = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
sys.path.insert(0, TESTS)
# Python workers import functions defined in test modules by name.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, TESTS] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p])


@pytest.fixture(scope="session")
def spark():
    from quire.session import build_session
    s = build_session("local[4]", 4, app="quire-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="quire-test-ckpt-"),
                             "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="quire-test-")
