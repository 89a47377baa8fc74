"""The registered queries: each operator on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanepulse import schemas as S
from lanepulse.functions import expressions as E
from lanepulse.functions import times
from lanepulse.operators import (
    changes, cleaning, indicators, output, reshape, slices, state, stations, windows,
)
from lanepulse.plans import adapters as A
from lanepulse.plans import intake_streams, round_trips, streams, traffic
from lanepulse.sources import ramp, tables

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

ALLOWED = "1, 3, 8, 46, 7, 16, 23, 99, 120"
MAP_STATIONS = intake_streams.MAP_STATIONS


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def registry() -> dict[str, Query]:
    return {**_REGISTRY, **round_trips.QUERIES, **streams.QUERIES, **intake_streams.QUERIES}


def _profile(spark, d) -> DataFrame:
    return windows.speed_profile(A.measurements(spark, d), **A.WINDOWS)


def _readings(spark, d) -> DataFrame:
    return windows.speed_readings(A.measurements(spark, d), **A.WINDOWS)


def _results(spark, d) -> DataFrame:
    return traffic.traffic_results(A.measurements(spark, d), A.locations(spark, d), **A.WINDOWS)


def _state(spark, d) -> DataFrame:
    return traffic.traffic_state(A.measurements(spark, d), A.locations(spark, d), **A.WINDOWS)


def _daily(spark, d) -> DataFrame:
    """Measurements with observation times cut to days."""
    return A.measurements(spark, d).withColumn(
        "recordTimestamp", F.date_trunc("day", "recordTimestamp").cast("timestamp_ntz"))


PROFILE_COLUMNS = (
    "uniqueId", "speed", "bezettingsgraad", "recordTimestamp", "avgSpeed3Minutes",
    "avgSpeed10Minutes", "originalRecordTimestamp",
)


# --- windows ---------------------------------------------------------------

@query
def speed_profile(spark, d):
    return _readings(spark, d).select(*PROFILE_COLUMNS)


@query
def speed_profile_minutes(spark, d):
    """The literal 3 and 10 minutes, with the default slices."""
    return windows.speed_readings(A.measurements(spark, d)).select(*PROFILE_COLUMNS)


@query
def speed_profile_ties(spark, d):
    """Observation times cut to days: many readings share an instant."""
    return windows.speed_readings(_daily(spark, d), **A.WINDOWS).select(
        *PROFILE_COLUMNS, "previousSpeed")


@query
def sliding_average(spark, d):
    return windows.sliding_avg(
        A.measurements(spark, d), "bezettingsgraad", "uniqueId", "recordTimestamp",
        6 * A.HOUR, slice_seconds=48 * A.HOUR)


@query
def sliding_maximum(spark, d):
    return windows.sliding_max(
        A.measurements(spark, d), "speed", "uniqueId", "recordTimestamp",
        6 * A.HOUR, slice_seconds=48 * A.HOUR)


@query
def previous_speed(spark, d):
    return windows.previous_speed(_readings(spark, d))


@query
def latest_averages(spark, d):
    return windows.latest_averages(_readings(spark, d))


# --- indicators ------------------------------------------------------------

@query
def traffic_jam(spark, d):
    return indicators.jam_indicator(_readings(spark, d)).select(
        "uniqueId", "speed", "trafficJamIndicator", "recordTimestamp",
        "originalRecordTimestamp")


@query
def speed_change(spark, d):
    return indicators.speed_diff(_readings(spark, d)).select(
        "uniqueId", "previousSpeed", F.col("speed").alias("currentSpeed"), "speedDiff",
        "bezettingsgraad", "recordTimestamp", "originalRecordTimestamp")


@query
def speed_diff_indicator(spark, d):
    return (
        _readings(spark, d)
        .transform(indicators.speed_diff)
        .transform(indicators.speed_diff_indicator)
        .select("uniqueId", "previousSpeed", F.col("speed").alias("currentSpeed"),
                "speedDiffIndicator", "bezettingsgraad", "recordTimestamp",
                "originalRecordTimestamp")
    )


# --- output ----------------------------------------------------------------

@query
def location_join(spark, d):
    return output.enrich_location(A.measurements(spark, d), A.locations(spark, d))


@query
def traffic_output(spark, d):
    return _results(spark, d)


@query
def traffic_output_ties(spark, d):
    """Result stream when many readings share an instant."""
    return traffic.traffic_results(_daily(spark, d), A.locations(spark, d), **A.WINDOWS)


@query
def tag_output(spark, d):
    """The jam variant alone, other columns NULL."""
    flagged = (
        _readings(spark, d).transform(indicators.jam_indicator)
        .withColumnRenamed("speed", "currentSpeed")
        .transform(output.enrich_location, A.locations(spark, d))
    )
    return output.tag_output(flagged, S.TRAFFIC_JAM)


@query
def variant_routing(spark, d):
    """Results of known variants, counted per variant."""
    return output.known_variants(_results(spark, d)).groupBy("outputType").agg(
        F.count(F.lit(1)).alias("n"), F.sum("currentSpeed").alias("total"))


@query
def routed_averages(spark, d):
    """One branch of the split by variant."""
    return output.route(_results(spark, d))[S.SPEED_AVG].select(
        "uniqueId", "currentSpeed", "avgSpeed3Minutes", "avgSpeed10Minutes", "recordTimestamp")


@query
def composite_key(spark, d):
    return output.composite_key(_results(spark, d)).select(
        "uniqueId", "outputType", "recordTimestamp", "outputType_recordTimestamp")


@query
def state_item(spark, d):
    return output.to_state_item(_results(spark, d))


@query
def dashboard_rows(spark, d):
    return output.dashboard_rows(_results(spark, d))


# --- changes and state -----------------------------------------------------

@query
def jam_change_points(spark, d):
    return traffic.jam_versions(
        A.measurements(spark, d), A.locations(spark, d), **A.WINDOWS
    ).select("uniqueId", "originalRecordTimestamp", "currentSpeed", "trafficJamIndicator", "loc")


@query
def speed_change_points(spark, d):
    return traffic.speed_change_versions(
        A.measurements(spark, d), A.locations(spark, d), **A.WINDOWS
    ).select("uniqueId", "originalRecordTimestamp", "previousSpeed", "currentSpeed",
             "speedDiffIndicator", "bezettingsgraad", "loc")


@query
def latest_reading(spark, d):
    """The newest row of each sensor, as an unconditional put leaves it."""
    profile = windows.latest_averages(_profile(spark, d))
    return state.latest_per_key(profile, ["uniqueId"], "originalRecordTimestamp")


@query
def latest_state(spark, d):
    return _state(spark, d)


@query
def latest_state_ties(spark, d):
    """State after readings that share their instants."""
    return traffic.traffic_state(_daily(spark, d), A.locations(spark, d), **A.WINDOWS).select(
        "uniqueId", "outputType", "recordTimestamp", "currentSpeed", "avgSpeed3Minutes",
        "speedDiffIndicator", "trafficJamIndicator")


@query
def change_feed(spark, d):
    feed = traffic.jam_feed(A.measurements(spark, d), A.locations(spark, d), **A.WINDOWS)
    return feed.select(
        "uniqueId", "originalRecordTimestamp",
        F.col("old.trafficJamIndicator").alias("oldIndicator"),
        F.col("old.recordTimestamp").alias("oldTimestamp"),
        F.col("new.trafficJamIndicator").alias("newIndicator"),
        F.col("new.recordTimestamp").alias("newTimestamp"),
    )


@query
def state_change_feed(spark, d):
    """Feed of both flag items; only entries with a jam flag go on to alerts."""
    results = traffic.change_results(
        A.measurements(spark, d), A.locations(spark, d), **A.WINDOWS
    ).where(F.col("outputType") != S.SPEED_AVG)
    flag = F.coalesce("speedDiffIndicator", "trafficJamIndicator")
    order = ["originalRecordTimestamp", "position"]
    options = {"slice_col": slices.SLICE}
    items = changes.change_points(
        results.withColumn("_flag", flag), S.STATE_KEYS, "_flag", order, **options)
    feed = changes.change_feed(items.drop("_flag"), S.STATE_KEYS, order, **options)
    return changes.jam_changes(feed).select(
        "uniqueId", "outputType", "originalRecordTimestamp",
        F.col("old").isNull().cast("int").alias("isNew"),
        F.col("new.trafficJamIndicator").alias("trafficJamIndicator"))


@query
def alert_versions(spark, d):
    return traffic.alert_versions(A.measurements(spark, d), A.locations(spark, d), **A.WINDOWS)


@query
def notifications(spark, d):
    return traffic.jam_notifications(
        A.measurements(spark, d), A.locations(spark, d), **A.WINDOWS)


@query
def current_situation(spark, d):
    items = state.current_situation(_state(spark, d))
    return items.select(
        "uniqueId",
        F.size("items").alias("n"),
        F.array_join(F.transform("items", lambda i: i["outputType_recordTimestamp"]), ",")
        .alias("keys"),
    )


@query
def current_situation_json(spark, d):
    return state.current_situation_json(_state(spark, d)).select(
        "uniqueId",
        F.json_object_keys("entry")[0].alias("sensor"),
        F.regexp_extract("entry", '"outputType":"([A-Z_]*)"', 1).alias("firstType"),
        F.size(F.split("entry", '"outputType":')).alias("parts"),
    )


@query
def current_alerts(spark, d):
    versions = traffic.alert_versions(
        A.measurements(spark, d), A.locations(spark, d), **A.WINDOWS)
    alerts = state.latest_per_key(versions, S.ALERT_KEYS, "originalRecordTimestamp")
    return state.current_alerts_json(alerts)


@query
def distinct_ids(spark, d):
    return state.distinct_ids(A.measurements(spark, d))


@query
def row_count(spark, d):
    return state.count_rows(A.measurements(spark, d))


@query
def flag_count(spark, d):
    flagged = traffic.flagged_profile(A.measurements(spark, d), **A.WINDOWS)
    return state.flag_count(flagged, "trafficJamIndicator", 1)


@query
def state_lookup(spark, d):
    return state.lookup(_state(spark, d), S.TRAFFIC_JAM, None, "trafficJamIndicator", 1).select(
        "uniqueId", "outputType", "trafficJamIndicator", "recordTimestamp")


@query
def key_scan(spark, d):
    return tables.scan_keys(A.table(spark, d, "events"), ["user_id", "event_type"])


# --- filters and cleaning --------------------------------------------------

@query
def unmeasured_filter(spark, d):
    return cleaning.drop_unmeasured(A.flat_events(spark, d, "event_id")).select(
        "event_id", "unieke_id", "voertuigsnelheid_harmonisch_klasse2")


@query
def sensor_allowlist(spark, d):
    return cleaning.allow_sensors(A.flat_events(spark, d, "event_id"), ALLOWED).select(
        "event_id", "unieke_id")


@query
def sensor_allowlist_table(spark, d):
    ids = A.table(spark, d, "supplier").select(F.col("s_suppkey").cast("string"))
    return cleaning.allow_sensors(A.flat_events(spark, d, "event_id"), ids).select(
        "event_id", "unieke_id")


@query
def input_filter(spark, d):
    return cleaning.matches_filter(A.flat_events(spark, d, "event_id"), ALLOWED).select(
        "event_id", "unieke_id", "voertuigsnelheid_harmonisch_klasse2")


@query
def class_removal(spark, d):
    cleaned = cleaning.remove_non_measurements(A.flat_events(spark, d, "event_id"))
    return cleaned.select("event_id", *[c for n in S.CLASSES for c in S.class_columns(n)])


@query
def disposition(spark, d):
    events = A.flat_events(spark, d, "event_id").withColumnRenamed("event_id", "recordId")
    tagged = cleaning.tag_disposition(events, "*")
    return tagged.select(
        "recordId", "result",
        F.get_json_object("data", "$.unieke_id").alias("sensor"),
        F.get_json_object("data", "$.voertuigsnelheid_rekenkundig_klasse1").alias("speed1"),
    )


@query
def preprocess(spark, d):
    return cleaning.preprocess(A.flat_events(spark, d, "event_id"), "*").select(
        "event_id", "unieke_id", "voertuigsnelheid_rekenkundig_klasse2",
        "voertuigsnelheid_harmonisch_klasse5")


@query
def json_parse(spark, d):
    """Events as JSON text -> 18 typed columns."""
    events = A.flat_events(spark, d).transform(reshape.normalize_time)
    records = events.select(F.to_json(F.struct(*S.FLAT_EVENT_COLUMNS)).alias("value"))
    return cleaning.parse_events(records)


@query
def json_parse_raw(spark, d):
    """Records that lack most fields: present ones are typed, others NULL."""
    return cleaning.parse_events(
        A.table(spark, d, "events").select(
            "event_id", F.regexp_replace("props", '"k"', '"lve_nr"').alias("value"))
    ).select("event_id", "lve_nr", "unieke_id")


@query
def measurements_from_events(spark, d):
    """Flat events -> filtered window input, in one projection."""
    events = A.flat_events(spark, d).transform(reshape.normalize_time)
    return traffic.measurements_from_events(events, "*").select(
        "uniqueId", "speed", "bezettingsgraad",
        F.unix_seconds("recordTimestamp").alias("observed"))


@query
def normalize_time(spark, d):
    events = A.flat_events(spark, d, "event_id")
    return events.select(
        "event_id",
        times.observed_epoch(F.col("tijd_waarneming"), "instant").alias("instant"),
        times.observed_epoch(F.col("tijd_waarneming"), "wall_clock").alias("wall_clock"))


@query
def english_names(spark, d):
    return reshape.rename_to_english(A.flat_events(spark, d)).select(
        "sensor_id", "observed_at", "occupancy", "intensity_c1", "speed_harm_c5")


# --- reshaping -------------------------------------------------------------

@query
def strip_marker(spark, d):
    return reshape.strip_marker(A.snapshot_stations(spark, d)).select(
        "unieke_id", "beschrijvende_id", F.col("meetdata")[0]["klasse_id"].alias("first_class"),
        F.size("meetdata").alias("classes"))


@query
def class_pivot(spark, d):
    pivoted = A.snapshot_stations(spark, d).transform(reshape.strip_marker).transform(
        reshape.pivot_classes)
    return pivoted.select("unieke_id", *[c for n in S.CLASSES for c in S.class_columns(n)])


@query
def flatten(spark, d):
    return reshape.flatten_struct(A.snapshot_stations(spark, d), "rekendata").select(
        F.col("`@unieke_id`").alias("unieke_id"),
        *[f"rekendata_{a}" for a in S.AGGREGATE_FIELDS])


@query
def flat_events(spark, d):
    return reshape.to_flat_events(A.snapshot_stations(spark, d))


@query
def clean_input(spark, d):
    events = A.flat_events(spark, d).transform(reshape.normalize_time, mode="wall_clock")
    return cleaning.clean_input(cleaning.type_input(events)).select(
        "uniqueId", "speed", "bezettingsgraad",
        F.unix_seconds("recordTimestamp").alias("observed"))


# --- expressions -----------------------------------------------------------

@query
def number_text(spark, d):
    """Integral amounts lose their fraction, others keep it."""
    half = F.floor(F.col("value") * 2) / 2
    return A.table(spark, d, "events").select("event_id", E.normalize_number(half).alias("n"))


@query
def payload_envelope(spark, d):
    """Base64 payloads, decoded again."""
    encoded = A.table(spark, d, "events").select(
        "event_id", E.encode_payload(F.col("props")).alias("data"))
    return encoded.select("event_id", "data", E.decode_payload(F.col("data")).alias("payload"))


@query
def landed_names(spark, d):
    """File names of the JSON that belongs to each page of raw input."""
    name = F.concat(
        F.lit("s3://bucket/xml/input/"), F.col("page_id").cast("string"), F.lit(".xml"))
    return A.table(spark, d, "pages").select(
        "page_id", E.landed_name(name, "xml/input/", "json/input/", ".json").alias("landed"))


# --- reference data --------------------------------------------------------

@query
def locations_build(spark, d):
    return stations.build_locations(A.station_config(spark, d))


@query
def station_filter(spark, d):
    return stations.filter_stations(A.station_config(spark, d), MAP_STATIONS).select(
        F.col("`@unieke_id`").alias("id"), "volledige_naam")


@query
def geojson_features(spark, d):
    return stations.geojson_features(A.station_config(spark, d)).select("id", "json")


@query
def geojson_collection(spark, d):
    return stations.geojson_collection(A.station_config(spark, d), MAP_STATIONS)


@query
def speed_ramp(spark, d):
    sensors = A.table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("string").alias("unieke_id"))
    return ramp.speed_ramp(sensors, start_ts=1_700_000_000, step=60)
