import random

import pytest
from pyspark.sql import functions as F

import fixtures as X
from lanepulse import schemas as S
from lanepulse.operators import changes, output, state
from lanepulse.plans import traffic

HOUR_MS = 3_600_000


def _versions(spark, rows):
    return spark.createDataFrame(
        rows, "uniqueId int, recordTimestamp long, trafficJamIndicator int, loc string")


def _locations(spark, ids=(812,)):
    return spark.createDataFrame([(i, f"place {i}") for i in ids], "id int, locatie string")


@pytest.mark.parametrize("seed", range(3))
def test_change_points_and_feed_match_brute_force(spark, seed):
    rng = random.Random(seed)
    rows, points, images = [], [], []
    for sensor in range(4):
        times = sorted(rng.sample(range(200), 60 if sensor else 190))
        last, stored = None, None
        for t in times:
            flag = rng.choice([0, 0, 1, -1, None])
            at = t * HOUR_MS // (1 if sensor else 7)
            rows.append((sensor, at, flag, None))
            if last is None or last[0] != flag:
                points.append((sensor, at, flag))
                images.append((sensor, at, stored, (at, flag)))
                stored = (at, flag)
            last = (flag,)
    found = changes.change_points(
        _versions(spark, rows), ["uniqueId"], "trafficJamIndicator", ["recordTimestamp"])
    assert found.columns == ["uniqueId", "recordTimestamp", "trafficJamIndicator", "loc"]
    got = [tuple(r)[:3] for r in found.collect()]
    assert sorted(got, key=repr) == sorted(points, key=repr)

    feed = changes.change_feed(found, ["uniqueId"], ["recordTimestamp"])
    got = [
        (r.uniqueId, r.recordTimestamp,
         r.old and (r.old.recordTimestamp, r.old.trafficJamIndicator),
         (r.new.recordTimestamp, r.new.trafficJamIndicator))
        for r in feed.collect()
    ]
    assert sorted(got, key=repr) == sorted(images, key=repr)


def test_golden_change_points(spark):
    m = X.measurements(spark, X.golden_rows())
    loc = _locations(spark)
    jam = traffic.jam_versions(m, loc).orderBy("recordTimestamp").collect()
    assert [(r.recordTimestamp // 1000 - X.START, r.trafficJamIndicator) for r in jam] == [
        (0, 0), (3000, 1), (3120, 0)]
    speed = traffic.speed_change_versions(m, loc).orderBy("recordTimestamp", "position").collect()
    assert [(r.recordTimestamp // 1000 - X.START, r.speedDiffIndicator) for r in speed] == [
        (0, 0), (120, 1), (180, 0), (240, -1), (240, 0), (1240, 1), (1300, 0), (1360, -1), (3000, 0), (3120, 1)]


@pytest.mark.parametrize("flags,expected", [
    ([0], []),
    ([1], [True]),
    ([0, 1, 0], [True, False]),
    ([-1, 0], [False]),
    ([1, -1, 1], [True, True]),
    ([1, 1, 0, 0, 1], [True, False, True]),
])
def test_notifications(spark, flags, expected):
    rows = [(1, i * 9 * HOUR_MS, f, "A" if f else None) for i, f in enumerate(flags)]
    jam = changes.change_points(
        _versions(spark, rows), ["uniqueId"], "trafficJamIndicator", ["recordTimestamp"])
    feed = changes.change_feed(jam, ["uniqueId"], ["recordTimestamp"])
    alerts = changes.alert_versions(feed)
    alert_feed = changes.change_feed(alerts, S.ALERT_KEYS, ["recordTimestamp"])
    notes = changes.notifications(alert_feed).orderBy("recordTimestamp").collect()
    assert [n.incoming for n in notes] == expected
    for n in notes:
        place = "A" if n.incoming else "1"
        text = ("New traffic jam at location: " + place if n.incoming
                else f"The traffic jam at location: {place} is gone!")
        assert n.message == text


def test_replayed_alerts_change_nothing(spark):
    rows = [(1, 1, 1, "A"), (1, 2, 1, "A"), (1, 3, 0, "A")]
    feed = changes.change_feed(_versions(spark, rows), ["uniqueId"], ["recordTimestamp"])
    found = changes.alert_versions(feed).orderBy("recordTimestamp").collect()
    assert [(r.recordTimestamp, r.alertIndicator) for r in found] == [(1, "1"), (3, "0")]


def test_feed_entries_without_jam_flag_are_ignored(spark):
    feed = spark.createDataFrame(
        [(1, None, (1,)), (2, (1,), None), (3, None, (None,))],
        "uniqueId int, old struct<trafficJamIndicator:int>, new struct<trafficJamIndicator:int>")
    assert [r.uniqueId for r in changes.jam_changes(feed).collect()] == [1]


def _state_by_hand(results):
    """Item by item, as a keyed store would be written."""
    table = {}
    for r in results:
        key = (str(r["uniqueId"]), r["outputType"])
        flag = {"SPEED_DIFFERENTIAL": "speedDiffIndicator",
                "TRAFFIC_JAM": "trafficJamIndicator"}.get(r["outputType"])
        if flag is None or key not in table or table[key][flag] != r[flag]:
            table[key] = r
    return {k: (str(r["recordTimestamp"]), r["currentSpeed"]) for k, r in table.items()}


@pytest.mark.parametrize("seed", range(3))
def test_latest_state_matches_keyed_writes(spark, seed):
    rows = [r for r in X.random_rows(seed) if r[1] is not None]
    m, loc = X.measurements(spark, rows), _locations(spark, range(3))
    items = traffic.traffic_state(m, loc, slice_seconds=900).collect()
    results = traffic.traffic_results(m, loc).withColumn(
        "first", (F.col("speedDiffIndicator") != 0).cast("int"))
    ordered = sorted(
        (r.asDict() for r in results.collect()),
        key=lambda r: (r["originalRecordTimestamp"], -(r["first"] or 0)))
    expected = _state_by_hand(ordered)
    assert {(i.uniqueId, i.outputType): (i.recordTimestamp, i.currentSpeed)
            for i in items} == expected
    rebuilt = output.to_state_item(
        state.latest_state(state.collapse_results(traffic.traffic_results(m, loc)))).collect()
    assert {(i.uniqueId, i.outputType): (i.recordTimestamp, i.currentSpeed)
            for i in rebuilt} == expected


def test_every_sensor_ends_with_three_items(spark):
    m = X.measurements(spark, X.golden_rows())
    items = traffic.traffic_state(m, _locations(spark))
    assert sorted(r.outputType for r in items.collect()) == sorted(S.OUTPUT_TYPES)
    speed = state.lookup(items, S.SPEED_DIFFERENTIAL, "812", "speedDiffIndicator", 1)
    assert speed.first().recordTimestamp == str((X.START + 3120) * 1000)
    assert state.lookup(items, S.SPEED_DIFFERENTIAL, "1", "speedDiffIndicator", 1).count() == 0
    situation = state.current_situation_json(items).collect()
    assert len(situation) == 1 and situation[0].entry.startswith('{"812":[{"uniqueId":"812"')


def test_latest_per_key_and_counts(spark):
    df = spark.createDataFrame(
        [(1, 5, 1), (1, 7, None), (2, 1, 1)], "k int, t int, flag int")
    newest = state.latest_per_key(df, ["k"], "t")
    assert sorted(map(tuple, newest.collect())) == [(1, 7, None), (2, 1, 1)]
    assert sorted(map(tuple, state.flag_count(df, "flag", 1, "k").collect())) == [(1, 1), (2, 1)]
    assert state.count_rows(df).first().n == 3
    assert state.distinct_ids(df, "k").count() == 2
