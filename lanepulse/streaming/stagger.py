"""Stagger windows: a sensor's window opens with its first reading, not with the clock.

It holds the readings of the next ``width`` and is closed by the sensor's next reading
behind its end or, if none comes, by a timer on event time. As in ``processor``, a
watermarked aggregation closes the instants first, so each sensor's instants come in
order and windows do not depend on how readings were dealt to micro-batches.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lanepulse.operators import windows
from lanepulse.streaming.processor import BUCKETS, NO_SENSOR

# Shipped with the query itself, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_COLUMNS = ("sensor", "start", "total", "n", "readings")
_OUT = ", ".join(f"{c} long" for c in _COLUMNS)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=list(_COLUMNS)).astype("int64")


class StaggerProcessor(StatefulProcessor):
    """Keeps one open window per sensor, its start and sums, as a row of its bucket's state.

    Calls to the state store are per bucket, so they do not grow with the sensors.
    """

    def __init__(self, width: int):
        self.width = width * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", ", ".join(f"{c} array<long>" for c in _COLUMNS))

    def _due(self, start: int) -> int:
        """Milliseconds at which the window is over, rounded up."""
        return -(-(start + self.width) // 1000)

    def _stored(self) -> dict[int, tuple]:
        """Open windows by sensor."""
        kept = self.open.get()
        return {} if kept is None else {row[0]: row[1:] for row in zip(*kept)}

    def _store(self, windows_: dict[int, tuple]) -> None:
        if windows_:
            rows = [(sensor, *w) for sensor, w in windows_.items()]
            self.open.update(tuple([int(v) for v in c] for c in zip(*rows)))
        else:
            self.open.clear()

    def _next(self, windows_: dict[int, tuple]) -> int | None:
        """When the first open window of the bucket is over."""
        return min((self._due(int(w[0])) for w in windows_.values()), default=None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        new = frames[0] if len(frames) == 1 else pd.concat(frames)
        sensors, at = new["sensor"].to_numpy(), new["us"].to_numpy()
        order = np.lexsort((at, sensors))
        sensors, at = sensors[order], at[order]
        # sums up to each instant, so that a window is a difference
        sums = [np.concatenate([[0], np.cumsum(new[c].fillna(0).to_numpy(np.int64)[order])])
                for c in ("speed_sum", "speed_n", "copies")]
        open_, closed = self._stored(), []
        before = self._next(open_)
        ends = np.append(np.flatnonzero(np.diff(sensors)) + 1, len(sensors))
        i = 0
        for end in ends:
            sensor, us = int(sensors[i]), at[:end]
            window = open_.get(sensor)
            while i < end:
                if window is None:
                    window = (int(us[i]), 0, 0, 0)
                j = i + int(np.searchsorted(us[i:], window[0] + self.width, "left"))
                window = (window[0], *(int(kept + s[j] - s[i]) for kept, s in zip(window[1:], sums)))
                if j < end:
                    closed.append((sensor, *window))
                    window = None
                i = j
            open_[sensor] = window
        after = self._next(open_)
        if before != after:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(after)
        self._store(open_)
        if closed:
            yield _frame(closed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # what was open at the watermark gets no more readings, whichever window the timer was of
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        open_ = self._stored()
        over = {sensor: w for sensor, w in open_.items() if self._due(int(w[0])) <= now}
        left = {sensor: w for sensor, w in open_.items() if sensor not in over}
        if left:
            self.handle.registerTimer(self._next(left))
        self._store(left)
        if over:
            yield _frame([(int(sensor), *map(int, w)) for sensor, w in over.items()])

    def close(self) -> None:
        pass


def stagger_windows(sdf: DataFrame, width: int, delay: str = "10 minutes") -> DataFrame:
    """(uniqueId, windowStart, avgSpeed, readings): a row per window of ``width`` seconds, once it is closed.

    ``sdf`` has the columns of ``clean_input``; readings without a time have no window, those
    without a sensor are a group of their own.
    """
    timed = sdf.where(F.col("recordTimestamp").isNotNull()).withWatermark("recordTimestamp", delay)
    instants = windows.collapse_instants(timed).withColumns({
        "us": F.unix_micros("ts"), "sensor": F.coalesce(F.col("uniqueId").cast("long"), F.lit(NO_SENSOR))})
    bucket = F.pmod(F.xxhash64("sensor"), F.lit(BUCKETS)).alias("bucket")
    found = instants.select(bucket, "sensor", "ts", "us", "speed_sum", "speed_n", "copies").groupBy("bucket") \
        .transformWithStateInPandas(
            StaggerProcessor(width), outputStructType=_OUT, outputMode="Append", timeMode="EventTime")
    return found.select(
        F.when(F.col("sensor") != NO_SENSOR, F.col("sensor")).cast("int").alias("uniqueId"),
        F.timestamp_micros("start").alias("windowStart"),
        F.expr("int(total div nullif(n, 0))").alias("avgSpeed"), "readings")
