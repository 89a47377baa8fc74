"""Sliding averages and previous speed per sensor.

Readings are first collapsed to one row per (sensor, instant): exact sums and
counts plus the number of readings (``copies``). Partial aggregation does most
of that before the shuffle, so replayed or piled-up readings of one sensor
cost one row. Every result of the analytics depends on the instant only, so
nothing is lost; ``repeat_copies`` gives back one row per reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanepulse.functions import times
from lanepulse.operators import slices

SHORT_SECONDS = 3 * 60
LONG_SECONDS = 10 * 60
# Slices of 24 look-backs: at most one row in 24 is copied into the next one.
SLICE_FACTOR = 24

INPUT = ("uniqueId", "recordTimestamp", "speed", "bezettingsgraad")


def collapse_instants(
    df: DataFrame,
    key: str = "uniqueId",
    ts: str = "recordTimestamp",
    speed: str = "speed",
    occupancy: str = "bezettingsgraad",
) -> DataFrame:
    """One row per (sensor, instant) with sums, counts and ``copies``."""
    return df.groupBy(F.col(key).alias("uniqueId"), F.col(ts).alias("ts")).agg(
        F.sum(speed).alias("speed_sum"),
        F.count(speed).alias("speed_n"),
        F.sum(occupancy).alias("occupancy_sum"),
        F.count(occupancy).alias("occupancy_n"),
        F.count(F.lit(1)).alias("copies"),
    )


def _int_avg(total: str, n: str) -> Column:
    """AVG landing in an INTEGER column: exact, rounded towards zero."""
    return F.expr(f"cast({total} div nullif({n}, 0) as int)")


def _over(fn: str, c: str, seconds: int) -> Column:
    """``fn(c)`` over the rows from ``seconds`` before to the current one."""
    return F.expr(
        f"{fn}({c}) over (partition by uniqueId, {slices.SLICE} order by ts "
        f"range between interval {seconds} second preceding and current row)")


def _profile(placed: DataFrame, short: int, long: int) -> DataFrame:
    w = Window.partitionBy("uniqueId", slices.SLICE).orderBy("ts")
    rows = placed.withColumn("speed", _int_avg("speed_sum", "speed_n"))
    # LAG and both frames share the ordering: one sort, one Window.
    rows = rows.select(
        "*",
        F.expr(f"lag(speed, 1, speed) over (partition by uniqueId, {slices.SLICE} "
               "order by ts)").alias("previousSpeed"),
        _over("sum", "speed_sum", short).alias("short_sum"),
        _over("sum", "speed_n", short).alias("short_n"),
        _over("sum", "speed_sum", long).alias("long_sum"),
        _over("sum", "speed_n", long).alias("long_n"),
    ).where("_own")
    return rows.select(
        "uniqueId",
        "speed",
        _int_avg("occupancy_sum", "occupancy_n").alias("bezettingsgraad"),
        times.epoch_millis(rows, "ts").alias("recordTimestamp"),
        _int_avg("short_sum", "short_n").alias("avgSpeed3Minutes"),
        _int_avg("long_sum", "long_n").alias("avgSpeed10Minutes"),
        F.col("ts").alias("originalRecordTimestamp"),
        "previousSpeed",
        "copies",
        slices.SLICE,
    )


def _placed(
    df: DataFrame, key: str, ts: str, speed: str, occupancy: str,
    short: int, long: int, slice_seconds: int | None,
) -> DataFrame:
    if not 0 <= short <= long:
        raise ValueError("windows must satisfy 0 <= short <= long")
    instants = collapse_instants(df, key, ts, speed, occupancy)
    return slices.with_lookback(
        instants, "uniqueId", "ts", slice_seconds or SLICE_FACTOR * max(long, 1), long)


def speed_profile(
    df: DataFrame,
    *,
    key: str = "uniqueId",
    ts: str = "recordTimestamp",
    speed: str = "speed",
    occupancy: str = "bezettingsgraad",
    short: int = SHORT_SECONDS,
    long: int = LONG_SECONDS,
    slice_seconds: int | None = None,
) -> DataFrame:
    """All sliding values, one row per (sensor, instant).

    Frames reach from ``short`` / ``long`` seconds before the instant up to
    and including it. ``previousSpeed`` is that of the first reading of the
    instant; further copies have the instant's own speed before them.
    """
    placed = _placed(df, key, ts, speed, occupancy, short, long, slice_seconds)
    return _profile(placed, short, long)


#: Copies of an instant that are given back at once.
PORTION = 4_096


def repeat_copies(profile: DataFrame, at_most: int | None = None) -> DataFrame:
    """One row per reading, ``position`` counting the copies from 0.

    ``at_most=2`` keeps what change detection needs: the first reading of an
    instant and one that follows it; all later ones equal the second.
    """
    if at_most is not None:
        few = F.sequence(F.lit(0), F.least("copies", F.lit(at_most)) - 1)
        return _as_readings(profile.withColumn("position", F.explode(few)))
    # in portions, so that no array is as long as an instant has copies
    first = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(PORTION).cast("long"))
    last = F.least(F.col("_first") + PORTION, F.col("copies")) - 1
    portions = profile.withColumn("_first", F.explode(first))
    return _as_readings(portions.withColumn("position", F.explode(F.sequence("_first", last))).drop("_first"))


def _as_readings(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "previousSpeed",
        F.when(F.col("position") == 0, F.col("previousSpeed")).otherwise(F.col("speed")),
    )


def speed_readings(
    df: DataFrame,
    *,
    key: str = "uniqueId",
    ts: str = "recordTimestamp",
    speed: str = "speed",
    occupancy: str = "bezettingsgraad",
    short: int = SHORT_SECONDS,
    long: int = LONG_SECONDS,
    slice_seconds: int | None = None,
) -> DataFrame:
    """All sliding values, one row per input row.

    Copies are given back last, in portions as they are written, so an instant
    with very many of them needs memory for a portion only.
    """
    placed = _placed(df, key, ts, speed, occupancy, short, long, slice_seconds)
    return repeat_copies(_profile(placed, short, long))


def _simple_window(
    df: DataFrame, fn: str, c: str, key: str, ts: str, seconds: int,
    slice_seconds: int | None,
) -> DataFrame:
    """One sliding aggregate per (key, instant), as ``value``."""
    partial = {
        "avg": [F.sum(c).alias("total"), F.count(c).alias("n")],
        "max": [F.max(c).alias("top")],
    }[fn]
    instants = df.groupBy(F.col(key).alias("uniqueId"), F.col(ts).alias("ts")).agg(*partial)
    placed = slices.with_lookback(
        instants, "uniqueId", "ts", slice_seconds or SLICE_FACTOR * max(seconds, 1), seconds)
    if fn == "avg":
        rows = placed.select(
            "*", _over("sum", "total", seconds).alias("t"), _over("sum", "n", seconds).alias("k"))
        value = _int_avg("t", "k")
    else:
        rows = placed.select("*", _over("max", "top", seconds).alias("t"))
        value = F.col("t")
    return rows.where("_own").select(
        F.col("uniqueId").alias(key), F.col("ts").alias(ts), value.alias("value"))


def sliding_avg(
    df: DataFrame, value: str, key: str, ts: str, seconds: int, *,
    slice_seconds: int | None = None,
) -> DataFrame:
    """Integer average over the last ``seconds``, one row per (key, instant)."""
    return _simple_window(df, "avg", value, key, ts, seconds, slice_seconds)


def sliding_max(
    df: DataFrame, value: str, key: str, ts: str, seconds: int, *,
    slice_seconds: int | None = None,
) -> DataFrame:
    """Maximum over the last ``seconds``, one row per (key, instant)."""
    return _simple_window(df, "max", value, key, ts, seconds, slice_seconds)


def latest_averages(profile: DataFrame) -> DataFrame:
    """The averages of each reading, without flags."""
    return profile.select(
        "uniqueId",
        F.col("speed").alias("currentSpeed"),
        "avgSpeed3Minutes",
        "avgSpeed10Minutes",
        "recordTimestamp",
        "originalRecordTimestamp",
    )


def previous_speed(readings: DataFrame) -> DataFrame:
    """Each reading next to the one before it."""
    return readings.select(
        "uniqueId",
        "previousSpeed",
        F.col("speed").alias("currentSpeed"),
        "bezettingsgraad",
        "recordTimestamp",
        "originalRecordTimestamp",
    )


def restarted_average(
    df: DataFrame, col: str, key: str, time: str, rows: int, unit: str, alias: str
) -> DataFrame:
    """Average of the last ``rows`` + 1 readings of the key, beginning anew each ``unit`` (minute, hour).

    The unit bounds the group that is sorted. Readings of one instant are ordered by value,
    NULL first; averages are rounded towards zero.
    """
    frame = Window.partitionBy(key, F.date_trunc(unit, time)).orderBy(time, col).rowsBetween(-rows, 0)
    total, n = F.sum(col).over(frame), F.count(col).over(frame)
    return df.withColumn(alias, F.when(n > 0, F.signum(total) * F.floor(F.abs(total) / n)).cast("int"))
