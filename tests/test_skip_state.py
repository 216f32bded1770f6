"""What the skipped-step check asks of a session's state."""

import random
from types import SimpleNamespace

import pandas as pd
import pytest
from driftline.streaming import skips

ORDINALS = {"signup": 1, "view": 2, "look": 2, "click": 3, "purchase": 4}


class State:
    def __init__(self, asked):
        self.rows, self.asked = [], asked

    def get(self):
        self.asked.append("get")
        return iter(self.rows)

    def appendList(self, rows):
        self.asked.append(len(rows))
        self.rows += rows

    def put(self, rows):
        self.asked.append(len(rows))
        self.rows = list(rows)

    def clear(self):
        self.rows = []


class Value(State):
    def get(self):
        return self.rows[0] if self.rows else None

    def update(self, row):
        self.rows = [row]


@pytest.mark.parametrize("pack", [10_000, 7])
def test_rows_wait_as_few_values(monkeypatch, pack):
    """A session's rows come twice, with some that must wait on; results are those of taking all in order of time and id."""
    monkeypatch.setattr(skips, "PACK", pack)
    rnd, asked, timers, names = random.Random(2), [], [], list(ORDINALS)
    rows = [(rnd.randrange(50) * 1_000_000, i, rnd.choice([0, 1, 2, 4] if i > 30 else [3, 4])) for i in range(60)]
    rows += [(100_000_000, 98, 3), (100_000_001, 99, 0)]
    given = pd.DataFrame(rows, columns=["us", "step_id", "stage"])
    own = skips.SkipProcessor(10 ** 6, ORDINALS)
    own.init(SimpleNamespace(getValueState=lambda *_: Value([]), getListState=lambda *_: State(asked), registerTimer=timers.append))
    for part in (given[::2], given[1::2]):
        assert list(own.handleInputRows(("s",), iter([part]), None)) == []
    assert asked == [1, 1] if pack > 62 else sum(asked) == 10
    found = []
    for mark in (60_000, 200_000):
        for frame in own.handleExpiredTimer(("s",), SimpleNamespace(getCurrentWatermarkInMs=lambda: mark), None):
            found += list(frame.itertuples(index=False, name=None))
    peak, want = 0, []
    for us, i, k in sorted(rows):
        if ORDINALS[names[k]] > peak + 1:
            want.append(("s", i, names[k], peak))
        peak = max(peak, ORDINALS[names[k]])
    assert found == want and want and own.waiting.rows == [] and own.furthest.rows == [(4, 100_000_001)]
