from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from bench import session  # noqa: E402

TESTDATA = Path(os.environ.get("DEMANDKIT_TESTDATA", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark():
    found = session()
    yield found
    found.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not TESTDATA.exists():
        pytest.skip("no test tables")
    return str(TESTDATA)
