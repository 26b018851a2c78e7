import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tribuna.session import build_session, prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests")
    prepare(s)
    yield s
    s.stop()
