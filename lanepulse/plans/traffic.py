"""The analytics end to end, as compositions of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lanepulse import schemas as S
from lanepulse.operators import (
    changes, cleaning, indicators, output, reshape, slices, state, windows,
)


def events_from_snapshot(stations: DataFrame, mode: str = "instant") -> DataFrame:
    """Snapshot stations -> flat events (the archive form)."""
    return reshape.to_flat_events(stations, mode)


def measurements_from_events(events: DataFrame, spec: str | DataFrame) -> DataFrame:
    """Flat events -> filtered, typed input of the windows."""
    return (
        events.transform(cleaning.preprocess, spec)
        .transform(cleaning.type_input)
        .transform(cleaning.clean_input)
    )


def flagged_profile(measurements: DataFrame, **options) -> DataFrame:
    """Sliding values and both flags, one row per (sensor, instant)."""
    return windows.speed_profile(measurements, **options).transform(
        indicators.traffic_indicators)


def traffic_results(
    measurements: DataFrame, locations: DataFrame, **options
) -> DataFrame:
    """The result stream: three records per measurement."""
    readings = windows.speed_readings(measurements, **options)
    return (
        readings.transform(indicators.traffic_indicators)
        .transform(output.traffic_output, locations)
        .select(*S.RESULT_COLUMNS)
    )


def change_results(measurements: DataFrame, locations: DataFrame, **options) -> DataFrame:
    """Result records as far as changes go: no third copy of an instant.

    Keeps ``position`` and the slice, so that (time, position) is unique per
    sensor and variant and change detection needs no further shuffle.
    """
    readings = windows.repeat_copies(windows.speed_profile(measurements, **options), at_most=2)
    return readings.transform(indicators.traffic_indicators).transform(
        output.traffic_output, locations)


def traffic_state(measurements: DataFrame, locations: DataFrame, **options) -> DataFrame:
    """Items of the latest-state table after all measurements."""
    results = change_results(measurements, locations, **options)
    order = ["originalRecordTimestamp", "position"]
    newest = state.latest_state(results, order, slice_col=slices.SLICE)
    return output.to_state_item(newest)


def jam_versions(measurements: DataFrame, locations: DataFrame, **options) -> DataFrame:
    """Versions of the jam item of each sensor: one row per change."""
    flagged = flagged_profile(measurements, **options)
    changed = changes.change_points(
        flagged, ["uniqueId"], "trafficJamIndicator", ["originalRecordTimestamp"],
        slice_col=slices.SLICE)
    rows = changed.transform(output.enrich_location, locations)
    return rows.selectExpr(
        "uniqueId", "originalRecordTimestamp", "recordTimestamp", "speed as currentSpeed",
        "trafficJamIndicator", "location as loc", slices.SLICE)


def speed_change_versions(
    measurements: DataFrame, locations: DataFrame, **options
) -> DataFrame:
    """Versions of the speed-change item of each sensor."""
    profile = windows.repeat_copies(windows.speed_profile(measurements, **options), at_most=2)
    changed = changes.change_points(
        profile.transform(indicators.traffic_indicators), ["uniqueId"], "speedDiffIndicator",
        ["originalRecordTimestamp", "position"], slice_col=slices.SLICE)
    rows = changed.transform(output.enrich_location, locations)
    return rows.selectExpr(
        "uniqueId", "originalRecordTimestamp", "position", "recordTimestamp",
        "previousSpeed", "speed as currentSpeed", "speedDiffIndicator", "bezettingsgraad",
        "location as loc", slices.SLICE)


def jam_feed(measurements: DataFrame, locations: DataFrame, **options) -> DataFrame:
    """Change feed of the jam items, old and new image."""
    versions = jam_versions(measurements, locations, **options)
    return changes.change_feed(
        versions, ["uniqueId"], ["originalRecordTimestamp"], slice_col=slices.SLICE)


def alert_versions(measurements: DataFrame, locations: DataFrame, **options) -> DataFrame:
    """Versions of the alert table."""
    return changes.alert_versions(
        jam_feed(measurements, locations, **options), ["originalRecordTimestamp"])


def jam_notifications(measurements: DataFrame, locations: DataFrame, **options) -> DataFrame:
    """Messages raised by the changes of the alert table."""
    versions = alert_versions(measurements, locations, **options)
    feed = changes.change_feed(versions, S.ALERT_KEYS, ["originalRecordTimestamp"])
    return changes.notifications(feed, ["originalRecordTimestamp"])
