import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

import fixtures as X
from lanepulse import schemas as S
from lanepulse.operators import cleaning, indicators, output
from lanepulse.plans import streams, traffic
from lanepulse.sinks import files
from lanepulse.sources import events, snapshots, tables
from lanepulse.streaming import batches, processor, queries
from test_files import snapshot_file, station_xml

COLUMNS = (
    "uniqueId", "speed", "bezettingsgraad", "recordTimestamp", "avgSpeed3Minutes",
    "avgSpeed10Minutes", "previousSpeed", "trafficJamIndicator", "speedDiffIndicator",
)
INPUT = "uniqueId int, seconds double, speed int, bezettingsgraad int"
CLOSING = (-1, X.START + 10_000_000.0, None, None)


def stream_of(spark, folder, *file_rows):
    """A file stream with one micro-batch per list of rows."""
    for i, rows in enumerate(file_rows):
        part = folder / f"{i:03}.json"
        part.write_text("".join(
            json.dumps(dict(zip(("uniqueId", "seconds", "speed", "bezettingsgraad"), r))) + "\n"
            for r in rows))
        # The file source takes older files first.
        stamp = 1_600_000_000 + i
        os.utime(part, (stamp, stamp))
    raw = spark.readStream.schema(INPUT).option("maxFilesPerTrigger", 1).json(str(folder))
    return raw.selectExpr(
        "uniqueId", "speed", "bezettingsgraad",
        "timestamp_micros(cast(seconds * 1000000 as bigint)) AS recordTimestamp")


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_stream_equals_batch(spark, tmp_path):
    """Several batches, rows late within the delay, copies across batches."""
    rows = [(s, X.START + 37.0 * i, (i * 31 + s) % 130, (i + s) % 4)
            for i in range(60) for s in (1, 2, 3)]
    rows += [(1, X.START + 37.0 * 9, 7, 3)] * 3
    rows.sort(key=lambda r: (int((r[1] - X.START) / 300), r[2]))
    size = len(rows) // 4 + 1
    parts = [rows[i:i + size] for i in range(0, len(rows), size)]
    sdf = stream_of(spark, tmp_path, *parts, [CLOSING])
    profile = queries.stream_speed_profile(sdf, delay="10 minutes")
    found = streams.run(queries.stream_readings(profile), "t")
    batch = traffic.windows.speed_readings(X.measurements(spark, rows)).transform(
        indicators.traffic_indicators)
    assert rows_of(found) == rows_of(batch)


def test_sensors_of_a_bucket_keep_values_of_their_own(spark, tmp_path):
    """Few rows of state for many sensors, some silent in a batch, one without an id."""
    rows = [(None if s == 7 else s, X.START + 45.0 * i + s, None if (i + s) % 9 == 0 else (i * 31 + s * 17) % 130,
             (i + s) % 4) for i in range(60) for s in range(-1, 8) if (i // 20 + s) % 3]
    rows.sort(key=lambda r: r[1])
    size = len(rows) // 3
    sdf = stream_of(spark, tmp_path, rows[:size], rows[size:2 * size], rows[2 * size:], [CLOSING])
    profile = queries.stream_speed_profile(sdf, delay="1 minute", buckets=2)
    found = streams.run(queries.stream_readings(profile), "buckets")
    batch = traffic.windows.speed_readings(X.measurements(spark, rows)).transform(
        indicators.traffic_indicators)
    assert rows_of(found) == rows_of(batch)


def test_state_is_read_and_written_once_for_all_sensors_of_a_bucket():
    calls, kept = [], []

    class Value:
        def get(self):
            calls.append("get")
            return kept[-1] if kept else None

        def update(self, value):
            calls.append("update")
            kept.append(value)

    class Handle:
        def getValueState(self, name, schema):
            return Value()

    p = processor.SpeedProcessor(180, 600, 40, 250, 20)
    p.init(Handle())
    names = ["sensor", "us", "speed_sum", "speed_n", "occupancy_sum", "occupancy_n", "copies"]
    for minute, sensors in enumerate(([1, 2, -1], [3, 2])):
        rows = [(s, (60 * minute + s) * 1_000_000, 50 * s + 30 * minute, 1, 0, 0, 1) for s in sensors]
        found = pd.concat(p.handleInputRows((0,), iter([pd.DataFrame(rows, columns=names)]), None))
        assert sorted(found["uniqueId"]) == sorted(sensors)
    assert calls == ["get", "update"] * 2
    before = dict(zip(found["uniqueId"], found["previousSpeed"]))
    assert before == {2: 100, 3: 180}  # a sensor's first reading has its own speed before it


def test_golden_run_in_a_stream(spark, tmp_path):
    rows = X.golden_rows()
    sdf = stream_of(spark, tmp_path, rows[:4], rows[4:], [CLOSING])
    profile = queries.stream_speed_profile(sdf, delay="1 minute")
    found = streams.run(profile, "golden").orderBy("recordTimestamp").collect()
    assert [r.avgSpeed3Minutes for r in found] == X.without_copy(X.GOLDEN_3_MINUTES)
    assert [r.avgSpeed10Minutes for r in found] == X.without_copy(X.GOLDEN_10_MINUTES)
    assert [r.previousSpeed for r in found] == X.without_copy(X.GOLDEN_PREVIOUS)
    assert [r.speedDiffIndicator for r in found] == X.without_copy(X.GOLDEN_CHANGE)
    assert [r.trafficJamIndicator for r in found] == X.without_copy(X.GOLDEN_JAM)


def test_late_and_untimed_rows_are_dropped(spark, tmp_path):
    first = [(1, X.START + 0.0, 100, 5), (1, X.START + 3600.0, 90, 5)]
    # A batch drops what the watermark of the batch before it has passed.
    second = [(1, X.START + 3600.0, 90, 5)]
    late = [(1, X.START + 10.0, 10, 5), (1, None, 10, 5), (1, X.START + 3660.0, 80, 5)]
    sdf = stream_of(spark, tmp_path, first, second, late, [CLOSING])
    found = streams.run(queries.stream_speed_profile(sdf, delay="1 minute"), "late")
    assert sorted(r.speed for r in found.collect()) == [80, 90, 100]


def test_arrivals_are_counted(spark, tmp_path):
    sdf = stream_of(spark, tmp_path, [(1, None, 1, 1), (1, X.START + 0.0, 1, 1)])
    query = queries.start(
        queries.observe_arrivals(sdf), lambda df, i: df.write.format("noop").mode("append").save(),
        str(tmp_path / "c"), trigger=None)
    query.awaitTermination()
    metrics = query.recentProgress[0].observedMetrics["arrivals"]
    assert (metrics.readings, metrics.untimed) == (2, 1)


def test_sinks_end_as_the_batch_does(spark, tmp_path):
    speeds = [120, 30, 20, 10, 10, 90, 120, 120]
    rows = X.sequence(speeds, step=240.0) + X.sequence([10, 10, 60], sensor=5, step=400.0)
    rows.sort(key=lambda r: r[1])
    folder = tmp_path / "in"
    folder.mkdir()
    sdf = stream_of(spark, folder, rows[:3], rows[3:7], rows[7:], [CLOSING])
    loc = spark.createDataFrame([(812, "Noordbrug")], "id int, locatie string")
    sinks = batches.TrafficSinks(str(tmp_path / "out"), loc)
    queries.start(
        queries.stream_speed_profile(sdf, delay="5 minutes"), sinks,
        str(tmp_path / "checkpoint"), trigger=None).awaitTermination()

    m = X.measurements(spark, rows)
    items = {tuple(r) for r in traffic.traffic_state(m, loc).collect()}
    assert {tuple(r) for r in tables.scan_state(spark, sinks.folder("state")).collect()} == items

    notes = spark.read.parquet(sinks.folder("notifications"))
    expected = traffic.jam_notifications(m, loc)
    both = [sorted((r.message, r.incoming) for r in df.collect()) for df in (notes, expected)]
    assert both[0] == both[1] and both[0]

    alerts = {tuple(r) for r in tables.scan_alerts(spark, sinks.folder("alerts")).collect()}
    assert alerts == {("812", "0", "Noordbrug"), ("5", "0", None)}

    archived = events.read_results_archive(spark, sinks.folder("archive"))
    published = events.read_results(spark.read.parquet(sinks.folder("stream")))
    wanted = traffic.traffic_results(m, loc)
    for df in (archived, published):
        got = df.select(*S.RESULT_COLUMNS).drop("originalRecordTimestamp").collect()
        assert sorted(map(str, got)) == sorted(
            map(str, wanted.drop("originalRecordTimestamp").collect()))
    assert spark.read.text(sinks.folder("dashboard")).count() == 3 * len(rows)


def test_archive_and_dashboard_hold_the_same_lines_in_less_room(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    rows = X.sequence([120, 30, 20, 10, 90] * 80, step=60.0)
    profile = streams.run(
        queries.stream_speed_profile(stream_of(spark, folder, rows, [CLOSING]), delay="1 minute"), "compressed")
    loc = spark.createDataFrame([(812, "Noordbrug")], "id int, locatie string")
    packed = batches.TrafficSinks(str(tmp_path / "packed"), loc)
    plain = batches.TrafficSinks(str(tmp_path / "plain"), loc, compression="none")
    for sinks in (packed, plain):
        sinks(profile, 0)

    def size(name, top):
        return sum(p.stat().st_size for p in (tmp_path / top / name).rglob("part-*"))

    for name in ("archive", "dashboard"):
        lines = [sorted(r.value for r in spark.read.text(s.folder(name)).collect()) for s in (packed, plain)]
        assert lines[0] == lines[1] and len(lines[0]) == 3 * len(rows)
        assert 5 * size(name, "packed") < size(name, "plain")


def test_dashboard_payload_is_a_list_of_one_object_without_an_array(spark):
    results = traffic.traffic_results(X.measurements(spark, X.random_rows(4, n=60)), spark.createDataFrame(
        [(1, 'a "b"\n[c]')], "id int, locatie string"))
    rows = output.dashboard_rows(results)
    found = files.dashboard_payload(results)
    wanted = rows.select(F.to_json(F.array(F.struct(*rows.columns))).alias("value"))
    assert sorted(found.collect()) == sorted(wanted.collect()) and found.schema == wanted.schema
    assert "array(" not in found._jdf.queryExecution().optimizedPlan().toString().split("\n")[0]


def test_snapshot_files_to_results(spark, tmp_path):
    """New XML files -> archive and results, one query each."""
    folder = tmp_path / "xml"
    for minute, speed in enumerate((120, 60, 30)):
        snapshot_file(
            folder, f"{minute}.xml",
            station_xml(615, [(2, 3, speed, speed)], f"2023-11-15T08:3{minute}:00+01:00"),
            station_xml(616, [(2, 0, 0, 252)], f"2023-11-15T08:3{minute}:00+01:00"))
        os.utime(folder / f"{minute}.xml", (1_600_000_000 + minute,) * 2)
    (folder / "skip.tmp").write_text("half written")

    def flat():
        stations = snapshots.read_snapshot_xml(spark, str(folder), stream=True, max_files=1)
        return traffic.events_from_snapshot(stations)

    archive = str(tmp_path / "archive")
    queries.archive_events(flat(), archive, str(tmp_path / "c1"), trigger=None).awaitTermination()
    archived = events.read_events_jsonl(spark, archive)
    assert archived.count() == 6

    m = traffic.measurements_from_events(flat(), "615, 616")
    results = queries.stream_traffic_output(queries.stream_speed_profile(m, delay="0 seconds"))
    found = streams.run(results, "xml-results").where("outputType = 'SPEED_AVG'")
    assert [r.avgSpeed3Minutes for r in found.orderBy("recordTimestamp").collect()] == [120, 90, 70]


def test_dead_letter(spark, tmp_path):
    calls = []

    def failing(df, batch_id):
        calls.append(batch_id)
        raise RuntimeError("sink down")

    df = spark.createDataFrame([(1, "a")], "id int, v string")
    batches.with_dead_letter(failing, str(tmp_path / "q"), retries=2)(df, 7)
    assert calls == [7, 7, 7]
    row = spark.read.json(str(tmp_path / "q")).first()
    assert (row.id, row.v, row.error, row.batch) == (1, "a", "RuntimeError: sink down", 7)

    calls.clear()

    def flaky(df, batch_id):
        calls.append(batch_id)
        if len(calls) < 3:
            raise RuntimeError("once more")

    batches.with_dead_letter(flaky, str(tmp_path / "none"))(df, 1)
    assert len(calls) == 3 and not (tmp_path / "none").exists()


def test_split_corrupt(spark):
    df = spark.createDataFrame([("1",), (None,)], "unieke_id string")
    good, bad = batches.split_corrupt(df)
    assert (good.count(), bad.count()) == (1, 1)


def test_settings_are_put_back(spark):
    before = spark.conf.get(queries.PARTITIONS)
    with pytest.raises(RuntimeError):
        with queries.settings(spark, {queries.PARTITIONS: "3"}):
            assert spark.conf.get(queries.PARTITIONS) == "3"
            raise RuntimeError
    assert spark.conf.get(queries.PARTITIONS) == before


def test_rows_in_state_are_not_counted_and_a_checkpoint_that_counted_goes_on(spark, tmp_path, monkeypatch):
    rows = [(s, X.START + 37.0 * i, (i * 31 + s) % 130, (i + s) % 4) for i in range(30) for s in (1, 2, 3)]
    parts = [rows[:40], rows[40:], [CLOSING]]
    folder = tmp_path / "in"
    folder.mkdir()

    def run_to(n):
        sdf = queries.stream_readings(
            queries.stream_speed_profile(stream_of(spark, folder, *parts[:n]), delay="1 minute"))
        query = queries.start(
            sdf, lambda df, i: df.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={i}"),
            f"{tmp_path}/checkpoint", trigger=None)
        query.awaitTermination()
        # the aggregation is the last of the stateful operators
        return [p.stateOperators[-1].numRowsTotal for p in query.recentProgress]

    with monkeypatch.context() as m:
        m.setattr(queries, "COUNT_ROWS", "spark.lanepulse.unused")
        assert max(run_to(1)) > 0
    assert max(run_to(3)) <= 0
    batch = traffic.windows.speed_readings(X.measurements(spark, rows)).transform(
        indicators.traffic_indicators)
    assert rows_of(spark.read.parquet(f"{tmp_path}/out")) == rows_of(batch)


def test_measurements_of_some_sensors_are_chosen_before_they_are_parsed(spark, capsys):
    sf_dir = "/root/testdata/sf0.001"
    for half in (0, 1):
        of = (F.col("uniqueId") == -1) | (F.pmod("uniqueId", F.lit(2)) == half)
        chosen = streams.measurement_stream(spark, sf_dir, of)
        chosen.explain()
        plan = capsys.readouterr().out
        assert "Filter" in plan[plan.index("get_json_object"):]
        later = streams.run(streams.measurement_stream(spark, sf_dir).where(of), "later")
        found = sorted(map(str, streams.run(chosen, "chosen").collect()))
        assert found == sorted(map(str, later.collect()))
        assert sum("uniqueId=-1," in r for r in found) == 1 < len(found)


def test_record_hook_on_a_stream(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"unieke_id":"1","voertuigsnelheid_harmonisch_klasse2":"80"}\n'
        '{"unieke_id":"1","voertuigsnelheid_harmonisch_klasse2":"252"}\n')
    sdf = events.read_events_jsonl(spark, str(tmp_path), stream=True, glob="*.json", max_files=1)
    out = streams.run(cleaning.preprocess(sdf, "*"), "hook")
    assert out.count() == 1


def test_union_form_equals_exploded_form(spark):
    m = X.measurements(spark, X.random_rows(3, n=80))
    loc = spark.createDataFrame([(1, "x")], "id int, locatie string")
    readings = traffic.windows.speed_readings(m).transform(indicators.traffic_indicators)
    a = output.traffic_output_by_union(readings, loc)
    b = output.traffic_output(readings, loc).select(*S.RESULT_COLUMNS)
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert a.where(F.col("location").isNull()).count() > 0
