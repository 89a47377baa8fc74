"""Queries that write the driver's tables through a sink and read them back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanepulse import schemas as S
from lanepulse import storage
from lanepulse.functions import times
from lanepulse.operators import cleaning, output, reshape, state, stations
from lanepulse.plans import adapters as A
from lanepulse.plans import traffic
from lanepulse.sinks import files
from lanepulse.sinks import tables as keyed
from lanepulse.sources import events as event_sources
from lanepulse.sources import snapshots, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Stations per snapshot document: bounds the list built for one document.
STATIONS_PER_DOCUMENT = 100
# Stations per XML file, as in a real snapshot; of a JSON file, a range of as many numbers.
STATIONS_PER_FILE = 4600
# Snapshots are mostly tags, so they are kept compressed; a file is read by one task anyway.
COMPRESSION = "gzip"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _write_snapshots(rows: DataFrame, path: str, root: str = "miv") -> None:
    (
        rows.write.format("xml")
        .option("rootTag", root).option("rowTag", "meetpunt")
        .option("attributePrefix", "@")
        .option("maxRecordsPerFile", STATIONS_PER_FILE)
        .option("compression", COMPRESSION)
        .save(path)
    )


def _results(spark, d) -> DataFrame:
    return traffic.traffic_results(A.measurements(spark, d), A.locations(spark, d), **A.WINDOWS)


def _with_wall_clock(results: DataFrame) -> DataFrame:
    """The zone-less UTC time of the source tables."""
    return results.withColumn("originalRecordTimestamp", times.utc_wall_clock(
        F.unix_micros("originalRecordTimestamp")))


@query
def snapshot_xml(spark, d):
    """XML snapshots -> flat events."""
    path = storage.work_folder(spark, "snapshot-xml")
    _write_snapshots(A.snapshot_stations(spark, d), path)
    return reshape.to_flat_events(snapshots.read_snapshot_xml(spark, path, glob=None))


@query
def snapshot_json(spark, d):
    """JSON snapshots, one document per group of stations -> flat events.

    The documents of a file are an array, so that files are as large as real snapshots.
    """
    path = storage.work_folder(spark, "snapshot-json")
    station_rows = A.snapshot_stations(spark, d)
    number = F.col("`@unieke_id`").cast("bigint")
    documents = (
        station_rows.withColumn("file", F.floor(number / STATIONS_PER_FILE))
        .repartition("file")  # both groups lie in its partitions
        .groupBy("file", F.floor(number / STATIONS_PER_DOCUMENT).alias("document"))
        .agg(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in station_rows.columns]))
             .alias("meetpunt"))
        .select("file", F.struct(F.struct("meetpunt").alias("miv")).alias("document"))
    )
    files_ = documents.groupBy("file").agg(F.collect_list("document").alias("documents"))
    files_.select(F.to_json("documents").alias("value")).write.option("maxRecordsPerFile", 1) \
        .option("compression", COMPRESSION).text(path)
    return reshape.to_flat_events(snapshots.read_snapshot_json(spark, path, glob="part-*"))


@query
def landed_snapshot(spark, d):
    """XML snapshots landed as JSON under a derived name, and read back."""
    xml = storage.work_folder(spark, "xml") + "/xml/input"
    landed = storage.work_folder(spark, "landed")
    _write_snapshots(A.snapshot_stations(spark, d), xml)
    named = snapshots.with_landed_name(snapshots.read_snapshot_xml(spark, xml, glob=None))
    files.land_json(named, landed, compression=COMPRESSION)
    back = spark.read.schema(S.SNAPSHOT_STATION).json(landed)
    return back.select(
        F.col("`@unieke_id`").alias("unieke_id"), F.size("meetdata").alias("classes"),
        F.col("rekendata.bezettingsgraad").alias("occupancy"))


@query
def raw_landing(spark, d):
    """Raw XML documents kept whole, before any parsing."""
    path = storage.work_folder(spark, "raw-in")
    kept = storage.work_folder(spark, "raw-kept")
    _write_snapshots(A.snapshot_stations(spark, d), path)
    files.land_raw(snapshots.read_raw_documents(spark, path, glob=None, ingest_ms=1), kept)
    documents = spark.read.parquet(kept)
    return documents.agg(
        F.sum(F.size(F.split("document", "<meetpunt ")) - 1).alias("stations"),
        F.sum(F.size(F.split("document", "<meetdata ")) - 1).alias("classes"),
        (F.countDistinct("name") == F.countDistinct("source_file")).alias("names_differ"))


@query
def snapshot_lines(spark, d):
    """Every line of the source is an entry of a station."""
    return A.snapshot_stations(spark, d).agg(
        F.sum(F.size("meetdata")).alias("lines"), F.count("*").alias("stations"))


@query
def events_jsonl(spark, d):
    """Flat events appended as JSON lines and read back."""
    path = storage.work_folder(spark, "events-jsonl")
    files.append_jsonl(A.flat_events(spark, d), path)
    return event_sources.read_events_jsonl(spark, path)


@query
def published_events(spark, d):
    """Flat events published as JSON records -> the typed input."""
    path = storage.work_folder(spark, "published")
    events = A.flat_events(spark, d).transform(reshape.normalize_time)
    files.publish_events(events, path)
    return cleaning.parse_events(spark.read.text(path))


@query
def published_results(spark, d):
    """Result records to the live stream table, decoded again."""
    path = storage.work_folder(spark, "stream")
    files.publish_results(_results(spark, d), path)
    decoded = event_sources.read_results(spark.read.parquet(path))
    return _with_wall_clock(decoded)


@query
def archived_records(spark, d):
    """Result records to the archive, read again, all columns."""
    path = storage.work_folder(spark, "results-archive")
    files.archive_results(_results(spark, d), path)
    return _with_wall_clock(event_sources.read_results_archive(spark, path))


@query
def archived_results(spark, d):
    """Ad-hoc SQL over archived events and results."""
    events = storage.work_folder(spark, "events-archive")
    results = storage.work_folder(spark, "results-archive")
    files.append_jsonl(A.flat_events(spark, d), events)
    files.archive_results(_results(spark, d), results)
    files.register_views(spark, events, results)
    return spark.sql("""
        SELECT outputType, count(*) AS n, sum(currentSpeed) AS total,
               (SELECT count(*) FROM raw_events) AS events
        FROM results GROUP BY outputType""")


def _written_state(spark, d) -> DataFrame:
    """State items, computed once into a table."""
    path = storage.work_folder(spark, "items")
    traffic.traffic_state(
        A.measurements(spark, d), A.locations(spark, d), **A.WINDOWS).write.parquet(path)
    return spark.read.schema(S.STATE).parquet(path)


@query
def state_table(spark, d):
    """State written in two batches, the second repeated, then scanned."""
    path = storage.work_folder(spark, "state")
    items = _written_state(spark, d)
    averages = F.col("outputType") == S.SPEED_AVG
    keyed.write_state(spark, path, items.where(averages), 0)
    keyed.write_state(spark, path, items, 1)
    keyed.write_state(spark, path, items.where(~averages), 1)
    return tables.scan_state(spark, path)


@query
def state_from_archive(spark, d):
    """State rebuilt from archived result records."""
    path = storage.work_folder(spark, "results-archive")
    files.archive_results(_results(spark, d), path)
    results = state.collapse_results(event_sources.read_results_archive(spark, path))
    return output.to_state_item(state.latest_state(results))


@query
def alert_table(spark, d):
    path = storage.work_folder(spark, "alerts")
    versions = traffic.alert_versions(
        A.measurements(spark, d), A.locations(spark, d), **A.WINDOWS)
    alerts = state.latest_per_key(versions, S.ALERT_KEYS, "originalRecordTimestamp")
    keyed.write_alerts(spark, path, alerts.select(*S.ALERT.fieldNames()))
    return tables.scan_alerts(spark, path)


@query
def notification_table(spark, d):
    path = storage.work_folder(spark, "notifications")
    notes = traffic.jam_notifications(
        A.measurements(spark, d), A.locations(spark, d), **A.WINDOWS)
    files.write_notifications(notes, path)
    return spark.read.schema(S.NOTIFICATION).parquet(path)


@query
def dashboard_feed(spark, d):
    """List-wrapped JSON rows of the dashboard feed."""
    path = storage.work_folder(spark, "dashboard")
    files.write_dashboard(_results(spark, d), path)
    row = F.get_json_object("value", "$[0].outputType_recordTimestamp")
    sensor = F.get_json_object("value", "$[0].uniqueId").cast("int")
    return spark.read.text(path).select(
        sensor.alias("uniqueId"), row.alias("outputType_recordTimestamp"))


@query
def location_table(spark, d):
    """Location table written as tab separated text, and read back."""
    path = storage.work_folder(spark, "locations")
    files.write_locations(stations.build_locations(A.station_config(spark, d)), path)
    return tables.read_locations(spark, path)


@query
def station_config_xml(spark, d):
    path = storage.work_folder(spark, "stations-xml")
    _write_snapshots(A.station_config(spark, d), path, root="mivconfig")
    cfg = snapshots.read_station_config(spark, path, glob=None)
    return cfg.withColumnRenamed("@unieke_id", "unieke_id")


@query
def json_dump(spark, d):
    """Full dump of the state as JSON lines."""
    path = storage.work_folder(spark, "dump")
    files.dump_json(_written_state(spark, d), path)
    return spark.read.schema(S.STATE).json(path)


@query
def cleared_table(spark, d):
    """A keyed table that was emptied and written again."""
    path = storage.work_folder(spark, "cleared")
    items = _written_state(spark, d)
    jam = F.col("outputType") == S.TRAFFIC_JAM
    keyed.write_state(spark, path, items.where(jam))
    keyed.clear_table(spark, path, S.STATE)
    keyed.write_state(spark, path, items.where(~jam))
    return tables.scan_state(spark, path).groupBy("outputType").agg(
        F.count(F.lit(1)).alias("n"))
