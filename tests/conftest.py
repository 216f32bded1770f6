import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from driftline.session import local_session
    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def cut_groups(monkeypatch):
    """Makes every group of more than a few rows count as huge."""
    from driftline.functions import ordered, quantile

    def at(rows):
        monkeypatch.setattr(ordered, "MAX_GROUP_ROWS", rows)
        monkeypatch.setattr(quantile, "MAX_GROUP_VALUES", rows)
    return at
