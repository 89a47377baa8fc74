from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

import fixtures as X
from lanepulse.operators import indicators, windows


def _rows(df):
    found = df.select(
        "uniqueId", (F.unix_micros("originalRecordTimestamp") / 1e6).alias("at"), "speed",
        "bezettingsgraad", "avgSpeed3Minutes", "avgSpeed10Minutes", "previousSpeed")
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_golden_run(spark):
    df = windows.speed_readings(X.measurements(spark, X.golden_rows()))
    rows = df.transform(indicators.traffic_indicators).orderBy("recordTimestamp", "speedDiffIndicator").collect()
    assert [r.speed for r in rows] == X.GOLDEN_SPEEDS
    assert [r.avgSpeed3Minutes for r in rows] == X.GOLDEN_3_MINUTES
    assert [r.avgSpeed10Minutes for r in rows] == X.GOLDEN_10_MINUTES
    assert [r.previousSpeed for r in rows] == X.GOLDEN_PREVIOUS
    assert [r.speedDiffIndicator for r in rows] == X.GOLDEN_CHANGE
    assert [r.trafficJamIndicator for r in rows] == X.GOLDEN_JAM
    assert rows[0].recordTimestamp == X.START * 1000
    assert rows[0].originalRecordTimestamp.replace(tzinfo=timezone.utc) == datetime.fromtimestamp(
        X.START, timezone.utc)


@pytest.mark.parametrize("speeds,change,jams", [
    ([110, 70, 45], -1, [0, 0, 0]),
    ([25, 70, 95], 1, [1, 0, 0]),
    ([88, 88], 0, [0, 0]),
])
def test_short_sequences(spark, speeds, change, jams):
    df = windows.speed_readings(X.measurements(spark, X.sequence(speeds)))
    rows = df.transform(indicators.traffic_indicators).orderBy("recordTimestamp").collect()
    assert rows[-1].speedDiffIndicator == change
    assert [r.trafficJamIndicator for r in rows] == jams


@pytest.mark.parametrize("slice_seconds", [600, 777, 250, 14_400, 10_000_000])
def test_slices_do_not_change_results(spark, slice_seconds):
    rows = X.random_rows(slice_seconds)
    df = windows.speed_readings(X.measurements(spark, rows), slice_seconds=slice_seconds)
    assert _rows(df) == X.brute_force(rows)


def test_hot_sensor_spans_many_slices(spark):
    rows = [(1, float(X.START + 30 * i), i % 130, 5) for i in range(3000)]
    rows += [(2, float(X.START + 600 * i), 50, 5) for i in range(100)]
    df = windows.speed_readings(X.measurements(spark, rows), slice_seconds=1200)
    assert _rows(df) == X.brute_force(rows)
    sizes = (
        windows.speed_profile(X.measurements(spark, rows), slice_seconds=1200)
        .groupBy("uniqueId", "_slice").count().agg(F.max("count")).first()[0])
    assert sizes <= 40


def test_frame_is_closed_at_both_ends(spark):
    rows = [(1, X.START, 100, 5), (1, X.START + 180, 50, 5), (1, X.START + 360.000001, 10, 5)]
    rows = [(a, float(b), c, d) for a, b, c, d in rows]
    found = _rows(windows.speed_readings(X.measurements(spark, rows)))
    assert [r[4] for r in sorted(found, key=lambda r: r[1])] == [75 if i == 1 else v
                                                                for i, v in enumerate([100, 0, 10])]


def test_average_is_truncated_before_the_flag(spark):
    rows = X.sequence([40, 41])
    df = windows.speed_readings(X.measurements(spark, rows)).transform(indicators.jam_indicator)
    last = df.orderBy("recordTimestamp").collect()[-1]
    assert (last.avgSpeed3Minutes, last.trafficJamIndicator) == (40, 1)


def test_silent_period_keeps_previous_speed(spark):
    rows = [(1, float(X.START), 90, 5), (1, float(X.START + 90 * 86_400), 20, 5)]
    found = sorted(_rows(windows.speed_readings(X.measurements(spark, rows))), key=lambda r: r[1])
    assert [r[6] for r in found] == [90, 90]
    assert [r[5] for r in found] == [90, 20]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Australia/Lord_Howe"])
def test_zoneless_times_ignore_the_session_zone(spark, zone):
    """Readings across clock changes, one per half hour."""
    rows = [(1, float(1_583_625_600 + 1800 * i), i % 100, 5) for i in range(100)]
    df = X.measurements(spark, rows).withColumn(
        "recordTimestamp", F.col("recordTimestamp").cast("timestamp_ntz"))
    expected = X.brute_force(rows, 3600, 7200)
    frame = df.toPandas()
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        again = spark.createDataFrame(
            frame, "uniqueId int, speed int, bezettingsgraad int, recordTimestamp timestamp_ntz")
        found = windows.speed_readings(again, short=3600, long=7200, slice_seconds=7200)
        ms = [tuple(r) for r in found.select(
            "uniqueId", (F.col("recordTimestamp") / 1000).alias("at"), "speed",
            "bezettingsgraad", "avgSpeed3Minutes", "avgSpeed10Minutes", "previousSpeed"
        ).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert sorted(ms, key=repr) == expected


def test_windows_must_be_ordered(spark):
    with pytest.raises(ValueError):
        windows.speed_profile(X.measurements(spark, []), short=600, long=180)


def test_simple_windows(spark):
    rows = X.random_rows(7)
    timed = [r for r in rows if r[1] is not None]
    df = X.measurements(spark, timed)
    avg = windows.sliding_avg(df, "speed", "uniqueId", "recordTimestamp", 600)
    top = windows.sliding_max(df, "speed", "uniqueId", "recordTimestamp", 600)
    at = (F.unix_micros("recordTimestamp") / 1e6).alias("at")
    found = sorted((tuple(r) for r in avg.select("uniqueId", at, "value").collect()), key=repr)
    expected = sorted({(r[0], r[1], r[5]) for r in X.brute_force(timed)}, key=repr)
    assert found == expected
    for sensor, second, value in top.select("uniqueId", at, "value").collect():
        speeds = [r[2] for r in timed if r[0] == sensor and second - 600 <= r[1] <= second
                  and r[2] is not None]
        assert value == (max(speeds) if speeds else None)


@pytest.mark.parametrize("avg,occupancy,flag", [
    (0, 1, 1), (40, 1, 1), (41, 1, 0), (250, 1, 0), (251, 1, -1), (20, 0, 0), (300, 0, 0),
    (None, 1, -1), (None, 0, 0), (20, None, -1), (60, None, 0), (-5, 1, -1),
])
def test_jam_flag(spark, avg, occupancy, flag):
    df = spark.createDataFrame(
        [(avg, occupancy)], "avgSpeed3Minutes int, bezettingsgraad int")
    assert indicators.jam_indicator(df).first().trafficJamIndicator == flag
    assert X.jam(avg, occupancy) == flag


@pytest.mark.parametrize("now,before,flag", [
    (120, 100, 1), (119, 100, 0), (80, 100, -1), (81, 100, 0), (None, 100, 0), (100, None, 0),
])
def test_speed_change_flag(spark, now, before, flag):
    df = spark.createDataFrame([(now, before)], "speed int, previousSpeed int")
    df = df.transform(indicators.speed_diff).transform(indicators.speed_diff_indicator)
    assert df.first().speedDiffIndicator == flag
