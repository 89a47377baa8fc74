"""Intake, quarantine, start bound, consumers, table changes and archives."""

import json
import os
import time

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanepulse import schemas as S
from lanepulse.operators import changes
from lanepulse.plans import intake_streams
from lanepulse.sinks import files
from lanepulse.sources import events, snapshots, tables
from lanepulse.streaming import batches, consumers, queries
from lanepulse.streaming.intake import Intake, start_bound
from test_files import snapshot_file, station_xml

LINES = "id string, v string, _corrupt string"


def prepare(rows):
    """Fails for each text that is no number."""
    number = F.coalesce(F.col("v").try_cast("int"), F.raise_error(F.concat(F.lit("bad "), "v")).cast("int"))
    return rows.select(F.col("id").cast("int").alias("id"), number.alias("v"))


def lines(spark, rows):
    return spark.createDataFrame([(str(i), v, None) for i, v in rows], LINES).repartition(4)


def test_failing_rows_are_found_one_by_one(spark, tmp_path):
    bad = {7: "x", 112: "y"}
    intake = Intake(str(tmp_path / "i"), prepare, {"no_id": "id IS NULL"}, retries=1)
    rows = [(i, bad.get(i, str(i * 2))) for i in range(200)]
    both = lines(spark, rows).unionByName(spark.createDataFrame([(None, "3", None)] * 2, LINES))
    intake(both, 4)
    good = spark.read.option("recursiveFileLookup", True).parquet(intake.staged).collect()
    assert sorted((r.id, r.v) for r in good) == [(i, i * 2) for i in range(200) if i not in bad]
    out = intake.read_quarantine(spark, both.schema).collect()
    assert sorted((r.id, r.reason) for r in out if r.id) == sorted((str(i), "failed") for i in bad)
    assert [r.reason for r in out if r.id is None] == ["no_id", "no_id"]
    assert all(f"bad {r.v}" in r.error for r in out if r.id)
    assert not (tmp_path / "i" / "attempt" / "run=none" / "batch=4").exists()


def test_equal_bad_rows_stay_together(spark, tmp_path):
    intake = Intake(str(tmp_path), prepare, retries=0)
    intake(lines(spark, [(1, "q")] * 50 + [(2, "2")]), 0)
    assert intake.read_quarantine(spark, T._parse_datatype_string(LINES)).count() == 50
    assert spark.read.option("recursiveFileLookup", True).parquet(intake.staged).count() == 1


def test_known_faults_go_in_one_pass_and_others_are_found(spark, tmp_path):
    trials = []

    def counted(rows):
        trials.append(1)
        return prepare(rows)

    def fault(rows):
        return F.when(F.col("v").startswith("x"), F.concat(F.lit("bad "), "v"))

    rows = lines(spark, [(i, f"x{i}" if i % 2 else str(i)) for i in range(40)])
    intake = Intake(str(tmp_path / "a"), counted, retries=0, faults=fault)
    intake(rows, 0)
    out = intake.read_quarantine(spark, rows.schema).collect()
    assert sorted((int(r.id), r.reason, r.error) for r in out) == [(i, "failed", f"bad x{i}") for i in range(1, 40, 2)]
    assert spark.read.option("recursiveFileLookup", True).parquet(intake.staged).count() == 20
    assert len(trials) == 2
    intake = Intake(str(tmp_path / "b"), prepare, retries=0, faults=fault)
    intake(lines(spark, [(1, "x1"), (2, "2"), (3, "y"), (4, None)]), 0)  # no fault names y; null is no number here
    assert sorted((r.id, r.v) for r in intake.read_quarantine(spark, rows.schema).collect()) == [
        ("1", "x1"), ("3", "y"), ("4", None)]


def test_batch_of_bad_rows_only_and_empty_batch(spark, tmp_path):
    intake = Intake(str(tmp_path), prepare, retries=0)
    intake(lines(spark, [(1, "q"), (2, "r")]), 0)
    intake(spark.createDataFrame([], LINES), 1)
    assert spark.read.schema("id int, v int").option("recursiveFileLookup", True).parquet(intake.staged).count() == 0
    assert intake.read_quarantine(spark, T._parse_datatype_string(LINES)).count() == 2


def test_batch_that_runs_again_leaves_its_files(spark, tmp_path):
    calls = []

    def counted(rows):
        calls.append(1)
        return prepare(rows)

    intake = Intake(str(tmp_path), counted, files=1)
    for _ in range(2):
        intake(lines(spark, [(1, "1"), (2, "2")]), 3)
        found = sorted(p for p in os.listdir(tmp_path / "staged" / "run=none" / "batch=3") if p.endswith(".parquet"))
    assert len(found) == 1 and len(calls) == 2  # tried, then its schema; not once more


def test_intake_feeds_a_stream_in_several_batches(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for k in range(5):
        rows = [{"id": str(10 * k + i), "v": "oops" if (k, i) == (3, 4) else str(i)} for i in range(10)]
        text = "\n".join(json.dumps(r) for r in rows) + '\n{"id": "cut'
        (source / f"{k}.json").write_text(text)
        os.utime(source / f"{k}.json", (1_600_000_000 + k,) * 2)
    (source / "other.txt").write_text("no reading")
    raw = snapshots.file_reader(spark, True, "*.json", max_files=1).schema(LINES) \
        .option("columnNameOfCorruptRecord", "_corrupt").json(str(source))
    intake = Intake(str(tmp_path / "out"), prepare, {"corrupt": "_corrupt IS NOT NULL"}, retries=0)
    taking = queries.start(raw, intake, str(tmp_path / "c1"), trigger=None)
    taking.awaitTermination()
    assert len(list((tmp_path / "out" / "staged").glob("run=*/batch=*"))) == 5
    sums = intake.read_staged(spark, T._parse_datatype_string("id int, v int"), max_files=1) \
        .groupBy().agg(F.count("*").alias("n"), F.sum("v").alias("v"))
    name = "taken"
    counting = sums.writeStream.format("memory").queryName(name).outputMode("complete") \
        .option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    counting.awaitTermination()
    assert tuple(spark.table(name).first()) == (49, 5 * 45 - 4)
    assert len([p for p in counting.recentProgress if p.numInputRows]) >= 4
    out = intake.read_quarantine(spark, T._parse_datatype_string(LINES)).collect()
    assert sorted(r.reason for r in out) == ["corrupt"] * 5 + ["failed"]


def test_start_bound_is_kept_and_old_files_stay_closed(spark, tmp_path):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "c")
    folder.mkdir()
    (folder / "old.parquet").write_bytes(b"no parquet at all")
    os.utime(folder / "old.parquet", (1_600_000_000,) * 2)
    bound = start_bound(spark, checkpoint)
    time.sleep(0.02)
    assert start_bound(spark, checkpoint) == bound and abs(bound / 1000 - time.time()) < 60
    spark.range(7).coalesce(1).write.parquet(str(tmp_path / "new"))
    part = next(p for p in os.listdir(tmp_path / "new") if p.endswith(".parquet"))
    os.rename(tmp_path / "new" / part, folder / "new.parquet")
    reader = snapshots.file_reader(spark, True, "*.parquet").schema("id long")
    seen = []
    rows = snapshots.modified_since(reader.parquet(str(folder)), bound)
    queries.start(rows, lambda b, i: seen.append(b.count()), checkpoint, trigger=None).awaitTermination()
    assert sum(seen) == 7


def test_rate_limit_by_bytes(spark, tmp_path):
    for k in range(6):
        (tmp_path / f"{k}.json").write_text('{"unieke_id": "1"}\n' * 20)
    rows = events.read_events_jsonl(spark, str(tmp_path), stream=True, max_bytes=800)
    seen = []
    queries.start(rows, lambda b, i: seen.append(b.count()), str(tmp_path / "c"), trigger=None).awaitTermination()
    assert sum(seen) == 120 and len(seen) >= 3


def test_corrupt_snapshots_keep_their_text(spark, tmp_path):
    folder = tmp_path / "xml" / "input"
    snapshot_file(folder, "1.xml", station_xml(614, [(2, 3, 87, 84)]),
                  '<meetpunt unieke_id="9"><lve_nr>1</meetpunt>', station_xml(615, [(2, 3, 80, 81)]))
    rows = snapshots.read_snapshot_xml(spark, str(folder), corrupt_col="_corrupt").cache()
    good, bad = batches.split_corrupt(rows, ("@unieke_id",), "_corrupt")
    assert good.count() >= 1 and bad.count() == 1 and rows.count() == good.count() + bad.count()
    assert "unieke_id=\"9\"" in bad.first()._corrupt
    rows.unpersist()
    docs = tmp_path / "json"
    docs.mkdir()
    (docs / "a.json").write_text(json.dumps({"miv": {"meetpunt": [{"@unieke_id": "1"}, {"@unieke_id": "2"}]}}))
    (docs / "b.json").write_text('{"miv": {"meetpunt": [')
    found = snapshots.read_snapshot_json(spark, str(docs), corrupt_col="_corrupt").collect()
    assert sorted(r["@unieke_id"] for r in found if r._corrupt is None) == ["1", "2"]
    assert [r._corrupt for r in found if r._corrupt] == ['{"miv": {"meetpunt": [']


def test_dead_letter_runs_the_plan_once(spark, tmp_path):
    spark.range(30).write.parquet(str(tmp_path / "in"))
    runs = spark.sparkContext.accumulator(0)
    import pyarrow as pa

    def counted(parts):
        for part in parts:
            runs.add(part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column("id")], names=["id"])

    rows = spark.read.parquet(str(tmp_path / "in")).mapInArrow(counted, "id long")

    def failing(df, batch_id):
        assert df.count() == 30
        raise RuntimeError("sink down")

    batches.with_dead_letter(failing, str(tmp_path / "q"), retries=2)(rows, 1)
    assert runs.value == 30
    assert spark.read.json(str(tmp_path / "q")).count() == 30


# --- consumers ----------------------------------------------------------------

RESULT_ROW = ("outputType", "uniqueId", "previousSpeed", "currentSpeed", "speedDiffIndicator", "trafficJamIndicator",
              "seconds")


def publish(spark, folder, k, rows):
    df = spark.createDataFrame(rows, "outputType string, uniqueId int, previousSpeed int, currentSpeed int, "
                               "speedDiffIndicator int, trafficJamIndicator int, seconds long")
    df = df.withColumns({
        "originalRecordTimestamp": F.timestamp_seconds("seconds"), "recordTimestamp": F.col("seconds") * 1000,
        **{c: F.lit(None).cast("int") for c in ("avgSpeed3Minutes", "avgSpeed10Minutes", "bezettingsgraad")},
        "location": F.lit("here")})
    files.publish_results(df.select(*S.RESULT_COLUMNS).coalesce(1), f"{folder}/p-{k}")


def consume(spark, folder, glob, checkpoint, items=None):
    source = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(f"{folder}/{glob}")
    seen = []

    def sink(records, batch_id):
        seen.extend(tuple(r) for r in records.select(
            "outputType", "uniqueId", "recordTimestamp", "speedDiffIndicator", "trafficJamIndicator").collect())
        consumers.StateTable(f"{folder}/state")(records, batch_id)

    records = consumers.written_records(events.read_results(source), items)
    queries.start(records, sink, checkpoint, trigger=None).awaitTermination()
    return seen


def test_consumer_writes_flags_only_when_they_change(spark, tmp_path):
    folder, jam, diff, avg = str(tmp_path), S.TRAFFIC_JAM, S.SPEED_DIFFERENTIAL, S.SPEED_AVG
    publish(spark, folder, 0, [
        (jam, 1, None, 50, None, 0, 10), (jam, 1, None, 30, None, 1, 20), (jam, 1, None, 30, None, 1, 15),
        (jam, None, None, 5, None, -1, 12), (avg, 1, None, 50, None, None, 10), (avg, 1, None, 30, None, None, 20),
        # copies of an instant: the second one has its own speed before it
        (diff, 1, 30, 30, 0, None, 30), (diff, 1, 60, 30, -1, None, 30), ("UNKNOWN", 1, None, 1, None, 1, 5)])
    publish(spark, folder, 1, [
        (jam, 1, None, 31, None, 1, 40), (jam, 1, None, 70, None, 0, 50), (diff, 1, 30, 32, 0, None, 40)])
    seen = consume(spark, folder, "p-[01]", f"{folder}/c0")
    assert sorted(seen, key=str) == sorted([
        (jam, 1, 10_000, None, 0), (jam, 1, 15_000, None, 1), (jam, None, 12_000, None, -1), (avg, 1, 20_000, None, None),
        (diff, 1, 30_000, -1, None), (diff, 1, 30_000, 0, None), (jam, 1, 50_000, None, 0)], key=str)
    # a new checkpoint goes on from the table, for the same sensors
    publish(spark, folder, 2, [
        (jam, 1, None, 71, None, 0, 60), (diff, 1, 32, 80, 1, None, 60), (jam, 2, None, 3, None, 0, 61)])
    items = tables.scan_state(spark, f"{folder}/state")
    again = consume(spark, folder, "p-2", f"{folder}/c1", items)
    assert sorted(again, key=str) == sorted([(diff, 1, 60_000, 1, None), (jam, 2, 61_000, None, 0)], key=str)
    stored = {(r.uniqueId, r.outputType): r.recordTimestamp for r in tables.scan_state(spark, f"{folder}/state").collect()}
    assert stored["1", jam] == "50000" and stored["1", diff] == "60000" and stored["1", avg] == "20000"


def test_flags_of_a_bucket_are_read_and_written_once():
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

    keeper = consumers.FlagKeeper()
    keeper.init(Handle())
    # places of the variants: 0 speed change, 1 jam, 2 average
    for stored in ([(1, 1, 0), (2, 1, 1)], [(2, 0, -1)]):
        keeper.handleInitialState((0,), pd.DataFrame(stored, columns=["sensor", "variant", "flag"]), None)
    calls.clear()
    columns = ["sensor", "variant", "us", "position", "flag", "value"]
    frames = [[(2, 1, 20, 0, 0, "b"), (1, 1, 10, 0, 0, "a"), (3, 2, 9, 0, 9, "c"), (2, 1, 30, 0, 0, "d")],
              [(2, 1, 10, 0, 1, "e"), (3, 2, 8, 0, 9, "f"), (2, 0, 5, 1, 0, "g"), (2, 0, 5, 0, -1, "h"),
               (4, 0, consumers.NO_TIME, 0, 1, "i"), (4, 0, 7, 0, 1, "j"), (-1, -1, 7, 0, 1, "k")]]
    found = pd.concat(keeper.handleInputRows((0,), iter([pd.DataFrame(f, columns=columns) for f in frames]), None))
    assert calls == ["get", "update"]
    assert sorted(zip(found["value"], found["position"], found["outputType"]), key=str) == [
        ("b", 0, S.TRAFFIC_JAM), ("c", 0, S.SPEED_AVG), ("g", 1, S.SPEED_DIFFERENTIAL), ("j", 0, S.SPEED_DIFFERENTIAL),
        ("k", 0, None)]
    assert sorted(zip(*kept[-1])) == [(1, 1, 0), (2, 0, 0), (2, 1, 0), (4, 0, 1)]


def test_sensors_of_a_bucket_keep_flags_of_their_own(spark, tmp_path):
    """Few rows of state, two consumers, some sensors silent in a batch, items in several frames."""
    folder, jam, diff, avg = str(tmp_path), S.TRAFFIC_JAM, S.SPEED_DIFFERENTIAL, S.SPEED_AVG
    rows, stored, writes, expected = [], {}, [], {}
    for i in range(40):
        batch = i // 10
        for s in (None, *range(-2, 9)):
            n = 0 if s is None else s
            if (batch + n) % 3 == 0:
                continue
            flag = (i * 7 + n * 5) // 4 % 3 - 1
            rows.append((batch, [(diff, s, 60, 50, flag, None, i), (jam, s, None, 50, None, -flag, i),
                                 (avg, s, None, 50 + i, None, None, i)]))
            for tag, value in ((diff, flag), (jam, -flag)):
                if stored.get((s, tag)) != value:
                    writes.append((tag, s, i * 1000))
                    expected[str(s), tag] = str(i * 1000)
                stored[s, tag] = value
    for k in range(4):
        publish(spark, folder, k, [r for batch, of in reversed(rows) if batch == k for r in of])
    table = f"{folder}/state"

    def run(glob, checkpoint, items=None):
        source = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(f"{folder}/{glob}")
        seen = []

        def sink(records, batch_id):
            seen.extend(tuple(r) for r in records.where("outputType <> 'SPEED_AVG'").select(
                "outputType", "uniqueId", "recordTimestamp").collect())
            consumers.StateTable(table)(records, batch_id)

        records = consumers.written_records(events.read_results(source), items, buckets=2)
        queries.start(records, sink, checkpoint, trigger=None).awaitTermination()
        return seen

    with queries.settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "5"}):
        seen = run("p-[01]", f"{folder}/c0") + run("p-[23]", f"{folder}/c1", tables.scan_state(spark, table))
    assert sorted(seen, key=str) == sorted(writes, key=str)
    left = {(r.uniqueId, r.outputType): r.recordTimestamp for r in tables.scan_state(spark, table).collect()}
    assert {k: v for k, v in left.items() if k[1] != avg} == expected


def test_records_of_a_sensor_are_published_in_order(spark, tmp_path):
    """Files are read some at a time, so a sensor's records of a landing are in one of them."""
    ts = (F.timestamp_seconds(F.col("id") * 40_000 + 1_700_000_000)).cast("timestamp_ntz")
    data = str(tmp_path / "data")
    spark.range(400).select(
        F.col("id").alias("event_id"), ts.alias("ts"), (F.col("id") % 9).alias("user_id"), F.lit("view").alias("event_type"),
        (F.col("id") * 37 % 130).cast("double").alias("value"), F.lit('{"k": 1}').alias("props")).coalesce(1) \
        .write.parquet(f"{data}/events.parquet")
    spark.createDataFrame([(1, "a")], "s_suppkey long, s_name string").write.parquet(f"{data}/supplier.parquet")
    folder = str(tmp_path / "out")
    with queries.settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        intake_streams._published(spark, data, folder)
    total = 0
    for k in range(4):
        placed = spark.read.parquet(f"{folder}/published-{k}").select(
            F.input_file_name().alias("file"), F.get_json_object("value", "$.uniqueId").alias("s"))
        assert placed.select("file").distinct().count() > 1
        assert placed.groupBy("s").agg(F.countDistinct("file").alias("n")).where("n > 1").count() == 0
        total += placed.count()
    assert total == 3 * 400


def test_published_files_can_be_shared_by_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "ROW_GROUP", 20_000, raising=False)
    rows = spark.range(3000).select(
        F.col("id").cast("int").alias("uniqueId"), F.timestamp_seconds("id").alias("originalRecordTimestamp"),
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in S.RESULT
          if f.name not in ("uniqueId", "originalRecordTimestamp")))
    files.publish_results(rows.coalesce(1), str(tmp_path / "p"))
    (path,) = (tmp_path / "p").glob("*.parquet")
    assert pq.ParquetFile(path).num_row_groups > 1
    assert events.read_results(spark.read.parquet(str(tmp_path / "p"))).agg(F.countDistinct("uniqueId")).first()[0] == 3000


# --- tables and archives ------------------------------------------------------

def test_table_changes(spark):
    before = spark.createDataFrame([(1, "a", 5), (2, "a", None), (3, "b", 7), (None, "n", 1)], "k int, s string, v int")
    after = spark.createDataFrame([(1, "a", 6), (2, "a", None), (4, "c", 8)], "k int, s string, v int")
    found = changes.table_changes(before, after, ["k", "s"]).collect()
    assert sorted((str(r.k), r.change, r.old and r.old.v, r.new and r.new.v) for r in found) == [
        ("1", "update", 5, 6), ("3", "delete", 7, None), ("4", "insert", None, 8), ("None", "delete", 1, None)]
    assert changes.table_changes(before, before.where("k IS NOT NULL").unionByName(before.where("k IS NULL")),
                                 ["k", "s"]).where("k IS NOT NULL").count() == 0


def archive_rows(spark, rows):
    return spark.createDataFrame(rows, "uniqueId int, seconds long").select(
        "uniqueId", F.timestamp_seconds("seconds").alias("originalRecordTimestamp"))


def test_archive_by_day_replaces_its_own_batch_and_prunes(spark, tmp_path, new_york):
    path, at = str(tmp_path / "a"), F.col("originalRecordTimestamp")
    day = 86_400
    files.archive_by_day(archive_rows(spark, [(1, 10), (2, day - 1), (3, day)]), path, at, "q", 0)
    files.archive_by_day(archive_rows(spark, [(4, day + 5), (5, None)]), path, at, "q", 1)
    files.archive_by_day(archive_rows(spark, [(4, day + 5), (5, None)]), path, at, "q", 1)
    schema = T._parse_datatype_string("uniqueId int, originalRecordTimestamp timestamp")
    rows = files.read_archive(spark, path, schema)
    assert sorted((r.uniqueId, str(r.day)) for r in rows.collect()) == [
        (1, "1970-01-01"), (2, "1970-01-01"), (3, "1970-01-02"), (4, "1970-01-02"), (5, "None")]
    some = rows.where("day = DATE '1970-01-02'")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    before = sorted(map(str, some.collect()))
    files.compact_day(spark, path, "1970-01-02")
    assert sorted(map(str, files.read_archive(spark, path, schema).where("day = DATE '1970-01-02'").collect())) == before
    kept = [f for _, _, fs in os.walk(f"{path}/day=1970-01-02") for f in fs if f.endswith(".json") or f.endswith(".txt")]
    assert len(kept) == 1
