"""Sliding averages and stored flags per sensor, as a stateful operator.

SQL window functions are refused on streams. A watermarked aggregation first
closes the instants (``streaming.queries``): it orders arrivals, drops what is
too late and merges copies before the shuffle. So the processor sees each
instant once, never older than one of an earlier batch, and keeps only the
last ten minutes and the stored flags. Sensors are dealt to buckets, whose rows
are computed together, so that calls do not grow with the sensors.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Shipped with the query itself, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Key of the readings without a sensor, which are a group of their own, as in
# batch. No sensor has it: ids are 32-bit. (NULL keys get mixed with others here.)
NO_SENSOR = 2**40

# Rows per emitted frame.
CHUNK = 10_000

#: Groups of sensors, by a hash, that share a row of state. A checkpoint keeps the number it began with.
BUCKETS = 1_024


def _array(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, T.ArrayType(kind))


# One value per bucket, so that a batch costs one read and one write for all its sensors.
# Per instant of the last ten minutes of a sensor, by sensor and time:
_INSTANTS = ("of", "us", "total", "n")
# per sensor, in order: its last speed and the stored flags.
_SENSORS = ("sensor", "speed", "jam_ms", "jam_speed", "jam_flag", "diff_flag")
_STATE = T.StructType([_array(c, T.LongType()) for c in _INSTANTS + _SENSORS])

PROFILE = T.StructType([
    T.StructField("uniqueId", T.IntegerType()),
    T.StructField("speed", T.IntegerType()),
    T.StructField("bezettingsgraad", T.IntegerType()),
    T.StructField("recordMicros", T.LongType()),
    T.StructField("avgSpeed3Minutes", T.IntegerType()),
    T.StructField("avgSpeed10Minutes", T.IntegerType()),
    T.StructField("previousSpeed", T.IntegerType()),
    T.StructField("trafficJamIndicator", T.IntegerType()),
    T.StructField("speedDiffIndicator", T.IntegerType()),
    T.StructField("copies", T.LongType()),
    # The items stored before this instant: NULL flags if there were none.
    T.StructField("storedJamTimestamp", T.LongType()),
    T.StructField("storedJamSpeed", T.IntegerType()),
    T.StructField("storedJamIndicator", T.IntegerType()),
    T.StructField("storedDiffIndicator", T.IntegerType()),
])


Masked = tuple[np.ndarray, np.ndarray]


def _averages(total: np.ndarray, n: np.ndarray) -> Masked:
    """Integer averages rounded towards zero, and where there is none (nothing was counted)."""
    safe = np.where(n == 0, 1, n)
    return np.sign(total) * (np.abs(total) // safe), n == 0


def _shifted(values: Masked, head: np.ndarray, stored: Masked) -> Masked:
    """Values moved on by one row; ``stored`` where a sensor's rows begin (``head``)."""
    return tuple(np.where(head, s, np.concatenate([v[:1], v[:-1]])) for v, s in zip(values, stored))


def _at(values: Masked, rows: np.ndarray) -> Masked:
    return values[0][rows], values[1][rows]


def _either(first: np.ndarray, yes: Masked, no: Masked) -> Masked:
    return np.where(first, yes[0], no[0]), np.where(first, yes[1], no[1])


def _known(values: np.ndarray) -> Masked:
    return values, np.zeros(len(values), bool)


def _frame(columns: dict[str, Masked], rows: slice) -> pd.DataFrame:
    def column(f: T.StructField) -> pd.arrays.IntegerArray:
        values, missing = (x[rows] for x in columns[f.name])
        kind = np.int64 if isinstance(f.dataType, T.LongType) else np.int32
        return pd.arrays.IntegerArray(np.where(missing, 0, values).astype(kind), missing.copy())

    return pd.DataFrame({f.name: column(f) for f in PROFILE.fields})


def _from_list(values: list) -> Masked:
    missing = np.array([v is None for v in values], bool)
    return np.array([v or 0 for v in values], np.int64), missing


def _to_list(values: Masked) -> list:
    return [None if gone else v for v, gone in zip(values[0].tolist(), values[1].tolist())]


class SpeedProcessor(StatefulProcessor):
    def __init__(self, short: int, long: int, low: int, high: int, threshold: int):
        self.short, self.long = short * 1_000_000, long * 1_000_000
        self.low, self.high, self.threshold = low, high, threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("sensors", _STATE)

    def _jam(self, avg: Masked, occupancy: Masked) -> np.ndarray:
        known, free = ~avg[1], ~occupancy[1] & (occupancy[0] == 0)
        slow = known & (avg[0] >= 0) & (avg[0] <= self.low) & ~occupancy[1] & ~free
        fast = known & (avg[0] > self.low) & (avg[0] <= self.high)
        return np.where(slow, 1, np.where(fast | free, 0, -1))

    def _change(self, now: Masked, before: Masked) -> np.ndarray:
        diff = np.where(now[1] | before[1], 0, now[0] - before[0])
        return np.where(diff >= self.threshold, 1, np.where(diff <= -self.threshold, -1, 0))

    def handleInputRows(
        self, key, rows: Iterator[pd.DataFrame], timerValues
    ) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        new = frames[0] if len(frames) == 1 else pd.concat(frames)
        sort = np.lexsort((new["us"].to_numpy(), new["sensor"].to_numpy()))

        def arrived(name: str) -> np.ndarray:
            # Sums are NULL where nothing was counted; no detour over floats.
            return new[name].astype("Int64").fillna(0).to_numpy(np.int64)[sort]

        kept = self.state.get() or ([],) * len(_STATE)
        past = [np.array(v, np.int64) for v in kept[:len(_INSTANTS)]]
        known = np.array(kept[len(_INSTANTS)], np.int64)
        items = [_from_list(v) for v in kept[len(_INSTANTS) + 1:]]

        # stored and new instants, by sensor and time
        both = [np.concatenate([v, arrived(c)]) for v, c in zip(past, ("sensor", "us", "speed_sum", "speed_n"))]
        order = np.lexsort((both[1], both[0]))
        of, us, total, n = (v[order] for v in both)
        mine = np.flatnonzero(order >= len(past[0]))
        sensors, group = np.unique(of, return_inverse=True)
        sums = np.concatenate([[0], np.cumsum(total)])
        counts = np.concatenate([[0], np.cumsum(n)])

        def sliding(width: int) -> Masked:
            # places of (sensor, time - width), by ranks, which fit a number whatever the times
            times, rank = np.unique(np.concatenate([us, us[mine] - width]), return_inverse=True)
            place = np.concatenate([group, group[mine]]) * len(times) + rank
            start = np.searchsorted(place[:len(us)], place[len(us):], side="left")
            return _averages(sums[mine + 1] - sums[start], counts[mine + 1] - counts[start])

        sensor, at, copies = of[mine], us[mine], arrived("copies")
        begin = np.flatnonzero(np.concatenate([[True], sensor[1:] != sensor[:-1]]))
        last = np.append(begin[1:], len(at)) - 1
        rows_of = last - begin + 1
        head = np.zeros(len(at), bool)
        head[begin] = True
        begin_of = np.repeat(begin, rows_of)

        # what is stored of the sensors that have new rows; nothing of those not seen before
        where = np.searchsorted(known, sensor[begin])
        seen = np.isin(sensor[begin], known)
        stored = [_at((np.append(v, 0), np.append(gone, True)), np.where(seen, where, len(known)))
                  for v, gone in items]
        seen_of = np.repeat(seen, rows_of)
        old_speed, old_ms, old_jam_speed, old_jam, old_diff = (
            (np.repeat(v, rows_of), np.repeat(gone, rows_of)) for v, gone in stored)

        speed = _averages(total[mine], n[mine])
        occupancy = _averages(arrived("occupancy_sum"), arrived("occupancy_n"))
        short, long = sliding(self.short), sliding(self.long)
        before = _shifted(speed, head, _either(seen_of, old_speed, speed))
        jam, change = self._jam(short, occupancy), self._change(speed, before)
        # a further copy of the instant has its own speed before it
        left = np.where(copies > 1, 0, change)
        stored_flag = _shifted(_known(jam), head, old_jam)
        stored_diff = _shifted(_known(left), head, old_diff)

        # the stored jam item is that of the sensor's last instant whose flag was new
        new_flag = stored_flag[1] | (stored_flag[0] != jam)
        newest = np.maximum.accumulate(np.where(new_flag, np.arange(len(at)), -1))
        item_of = np.concatenate([[-1], newest[:-1]])
        earlier = item_of < begin_of
        at_ms = _known(at // 1000)

        columns = {
            "uniqueId": (sensor, sensor == NO_SENSOR), "speed": speed, "bezettingsgraad": occupancy,
            "recordMicros": _known(at),
            "avgSpeed3Minutes": short, "avgSpeed10Minutes": long, "previousSpeed": before,
            "trafficJamIndicator": _known(jam), "speedDiffIndicator": _known(change), "copies": _known(copies),
            "storedJamTimestamp": _either(earlier, old_ms, _at(at_ms, item_of)),
            "storedJamSpeed": _either(earlier, old_jam_speed, _at(speed, item_of)),
            "storedJamIndicator": stored_flag, "storedDiffIndicator": stored_diff,
        }

        # sensors without new rows keep theirs
        item = newest[last]
        unchanged = item < begin
        now = [_at(speed, last), *(
            _either(unchanged, old, _at(of_row, item)) for old, of_row in zip(
                stored[1:4], (at_ms, speed, _known(jam)))), _known(left[last])]
        silent = ~np.isin(known, sensor[begin])
        names = np.concatenate([known[silent], sensor[begin]])
        by_name = np.argsort(names)
        items = [_to_list(tuple(np.concatenate([o[silent], v])[by_name] for o, v in zip(old, value)))
                 for old, value in zip(items, now)]
        ends = np.searchsorted(of, sensors, side="right") - 1
        keep = us >= us[ends][group] - self.long
        self.state.update(tuple(v[keep].tolist() for v in (of, us, total, n)) + (names[by_name].tolist(), *items))
        for first in range(0, len(at), CHUNK):
            yield _frame(columns, slice(first, first + CHUNK))

    def close(self) -> None:
        pass
