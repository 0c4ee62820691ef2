import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

import crosscheck  # noqa: E402

from gridvoice.sources import scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = crosscheck.session("*")
    yield session
    scratch.drop_all(session)
    session.stop()
