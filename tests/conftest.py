from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for p in (str(ROOT), str(ROOT / "tests")):
    if p not in sys.path:
        sys.path.insert(0, p)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kinelake.session import build_session

    s = build_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return SMALL


@pytest.fixture
def con(small):
    """A database for each test: an error inside the engine must not spoil the tests that follow."""
    import harness

    c = harness.Database(small)
    yield c
    c.close()
