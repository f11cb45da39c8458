"""State of the gap check: which minutes of a listing have come, within the span that later ones can reach."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


def pairs(minutes: np.ndarray, search: int) -> set[tuple[int, int]]:
    """Neighbouring minutes with others missing between them, if within the search span."""
    apart = np.diff(minutes)
    at = np.flatnonzero((apart > 1) & (apart <= search))
    return set(zip(minutes[at].tolist(), minutes[at + 1].tolist()))


class GapState(StatefulProcessor):
    """By listing: the minutes (numbers since the epoch, in order, as four bytes each) from the watermark less the search span on,
    and the timer that is set.

    No minute that is still to come reaches further back, so older ones are dropped whenever the listing has input, and by
    the timer where it has none: the state of a listing never holds more than the search span and the lateness, and
    that of one that has ended is cleared.
    """

    OUTPUT = "listing_id int, previous long, minute long, missing long, present boolean"

    def __init__(self, search_minutes: int):
        self.search = search_minutes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("minutes", "minutes binary, timer long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        known, timer = self._read()
        came = [(pd.to_datetime(f["minute"]).astype("int64").to_numpy() // (60 * _unit(f["minute"]))).astype(np.int64) for f in rows]
        all_ = np.union1d(known, np.concatenate(came)) if came else known
        before, after = pairs(known, self.search), pairs(all_, self.search)
        changes = [(*p, False) for p in sorted(before - after)] + [(*p, True) for p in sorted(after - before)]
        self._keep(all_, timer, timerValues.getCurrentWatermarkInMs())
        yield self._rows(key, changes)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        known, _ = self._read()
        self._keep(known, 0, timerValues.getCurrentWatermarkInMs())
        yield self._rows(key, [])

    def close(self) -> None:
        pass

    def _read(self) -> tuple[np.ndarray, int]:
        if not self.state.exists():
            return np.empty(0, np.int64), 0
        data, timer = self.state.get()
        return np.frombuffer(data, np.int32).astype(np.int64), timer

    def _keep(self, minutes: np.ndarray, timer: int, watermark: int) -> None:
        left = minutes[minutes >= watermark // 60_000 - self.search]
        if not len(left):
            if timer:
                self.handle.deleteTimer(timer)
            self.state.clear()
            return
        if not timer:
            timer = int(left[-1] + self.search + 1) * 60_000
            self.handle.registerTimer(timer)
        self.state.update((left.astype(np.int32).tobytes(), timer))

    @staticmethod
    def _rows(key: Any, changes: list[tuple[int, int, bool]]) -> pd.DataFrame:
        rows = [(key[0], a * 60, b * 60, b - a - 1, present) for a, b, present in changes]
        return pd.DataFrame(rows, columns=["listing_id", "previous", "minute", "missing", "present"]).astype({"listing_id": "int32", "present": "bool"})


def _unit(times: pd.Series) -> int:
    """Ticks a second of a series of times."""
    return {"s": 1, "ms": 10**3, "us": 10**6, "ns": 10**9}[times.dt.unit]
