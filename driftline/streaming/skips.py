"""State kept for the skipped-step check."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


UNNUMBERED = -(1 << 63)         # stands for a null id, which state and frames could not hold as a number
ROW = np.dtype([("us", "<i8"), ("step_id", "<i8"), ("stage", "<i4")])
PACK = 10_000                   # rows of one value of the state, at most


class SkipProcessor(StatefulProcessor):
    """Holds a session's rows until the watermark has passed them, then takes them in time order.

    Rows wait packed, all that come together as one value, since each value of a state costs a conversion on either side. Stages are numbers
    in the order of ``ordinals``. Only the furthest place outlives the rows, until nothing has come for ``forget_ms`` of event time.
    """

    def __init__(self, forget_ms: int, ordinals: dict[str, int]):
        self.forget_ms = forget_ms
        self.stages, self.places = list(ordinals), [int(p) for p in ordinals.values()]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.furthest = handle.getValueState("furthest", "place int, last_us bigint")
        self.waiting = handle.getListState("waiting", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for chunk in rows:
            if len(chunk):
                held = np.empty(len(chunk), ROW)
                for c in ROW.names:
                    held[c] = chunk[c].to_numpy()
                self.waiting.appendList(packed(held))
                least = int(held["us"].min())
                first = least if first is None else min(first, least)
        if first is not None:
            self.handle.registerTimer(-(-first // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held = np.frombuffer(b"".join(bytes(r[0]) for r in self.waiting.get()), ROW)
        now = held["us"] <= passed
        ready, rest = held[now], held[~now]
        peak, last = self.furthest.get() or (0, 0)
        if len(ready):
            ready = ready[np.lexsort((ready["step_id"], ready["us"]))]
            place = np.array(self.places, np.int64)[ready["stage"]]
            upto = np.maximum.accumulate(np.concatenate([[peak], place]))
            skips = place > upto[:-1] + 1
            peak, last = int(upto[-1]), max(last, int(ready["us"][-1]))
            self.furthest.update((peak, last))
            if len(rest):
                self.waiting.put(packed(rest))
            else:
                self.waiting.clear()
        if len(rest):
            self.handle.registerTimer(-(-int(rest["us"].min()) // 1000))
        elif passed >= last + 1000 * self.forget_ms:
            self.furthest.clear()
        else:
            self.handle.registerTimer(-(-last // 1000) + self.forget_ms)
        if len(ready) and skips.any():
            found = ready[skips]
            yield pd.DataFrame({"session_id": [key[0]] * len(found), "step_id": found["step_id"].astype(np.int64),
                                "stage": [self.stages[k] for k in found["stage"]], "reached": upto[:-1][skips].astype(np.int32)})

    def close(self) -> None:
        pass


def packed(rows: np.ndarray) -> list[tuple[bytes]]:
    return [(rows[i:i + PACK].tobytes(),) for i in range(0, len(rows), PACK)]
