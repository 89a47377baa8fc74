"""Small inputs shared by the tests."""

from __future__ import annotations

import random

START = 1_700_000_007

# Golden run, made from the rules: one sensor, occupancy 6. Changes of 19 and 20 in both
# directions, two readings at one instant, two silences longer than any window, a jam.
GOLDEN_READINGS = [
    (0, 61), (60, 80), (120, 100), (180, 81), (240, 50), (240, 72), (1240, 140), (1300, 139), (1360, 0),
    (3000, 12), (3060, 31), (3120, 90)]
GOLDEN_SPEEDS = [61, 80, 100, 81, 61, 61, 140, 139, 0, 12, 31, 90]
GOLDEN_3_MINUTES = [61, 70, 80, 80, 76, 76, 140, 139, 93, 12, 21, 44]
GOLDEN_10_MINUTES = [61, 70, 80, 80, 74, 74, 140, 139, 93, 12, 21, 44]
GOLDEN_PREVIOUS = [61, 61, 80, 100, 81, 61, 61, 140, 139, 0, 12, 31]
GOLDEN_CHANGE = [0, 0, 1, 0, -1, 0, 1, 0, -1, 0, 0, 1]
GOLDEN_JAM = [0] * 9 + [1, 1, 0]
#: The second reading of an instant; a stream of instants has no row for it.
GOLDEN_COPY = 5


def golden_rows(sensor=812):
    return [(sensor, START + float(at), speed, 6) for at, speed in GOLDEN_READINGS]


def without_copy(values):
    return values[:GOLDEN_COPY] + values[GOLDEN_COPY + 1:]


def measurements(spark, rows):
    """(sensor, epoch seconds or None, speed, occupancy) -> window input."""
    return spark.createDataFrame(
        rows, "uniqueId int, seconds double, speed int, bezettingsgraad int"
    ).selectExpr(
        "uniqueId", "speed", "bezettingsgraad",
        "timestamp_micros(cast(seconds * 1000000 as bigint)) AS recordTimestamp")


def sequence(speeds, sensor=812, occupancy=6, step=1.0, start=START):
    return [(sensor, start + step * i, s, occupancy) for i, s in enumerate(speeds)]


def random_rows(seed, n=400, sensors=5, span=40_000):
    """Readings with copies, silent periods, NULL speeds, times and occupancies.

    Sensor 0 holds a third of all rows, many of them at one instant.
    """
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        sensor = 0 if rng.random() < 0.33 else rng.randrange(1, sensors)
        seconds = float(rng.randrange(span // 20) * 20 + START)
        if rng.random() < 0.3:
            seconds = START + 7 * span + rng.randrange(5) * 0.5
        if sensor == 0 and rng.random() < 0.5:
            seconds = START + 12_345.0
        if rng.random() < 0.03:
            seconds = None
        speed = None if rng.random() < 0.1 else rng.randrange(0, 140)
        occupancy = None if rng.random() < 0.1 else rng.choice([0, 0, 3, 6, 50])
        rows.append((sensor, seconds, speed, occupancy))
    return rows


def _avg(values):
    values = [v for v in values if v is not None]
    return int(sum(values) / len(values)) if values else None


def brute_force(rows, short=180, long=600):
    """Row-by-row definition of the sliding values, as a sorted list.

    (sensor, seconds, speed, occupancy, short avg, long avg, previous)
    """
    out = []
    for sensor in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == sensor),
                      key=lambda r: (r[1] is not None, r[1] or 0))
        last, seen = None, False
        for _, at, _, _ in mine:
            def within(width, at=at, mine=mine):
                if at is None:
                    return [r for r in mine if r[1] is None]
                return [r for r in mine if r[1] is not None and at - width <= r[1] <= at]

            now = within(0)
            speed = _avg([r[2] for r in now])
            out.append((
                sensor, at, speed, _avg([r[3] for r in now]),
                _avg([r[2] for r in within(short)]), _avg([r[2] for r in within(long)]),
                last if seen else speed,
            ))
            last, seen = speed, True
    return sorted(out, key=repr)


def jam(avg, occupancy):
    if avg is not None and 0 <= avg <= 40 and occupancy not in (None, 0):
        return 1
    if (avg is not None and 41 <= avg <= 250) or occupancy == 0:
        return 0
    return -1
