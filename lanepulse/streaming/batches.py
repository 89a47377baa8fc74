"""What happens to each micro-batch: sinks, retries, quarantine."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanepulse import schemas as S
from lanepulse import storage
from lanepulse.operators import changes, output, state
from lanepulse.sinks import files, tables
from lanepulse.streaming import queries
from lanepulse.streaming.intake import batch_folder, run_of

log = logging.getLogger(__name__)
BatchFn = Callable[[DataFrame, int], None]


def write_quarantine(df: DataFrame, path: str, batch_id: int, error: str) -> None:
    """Failed rows as JSON lines with the error that hit them."""
    df.withColumn("error", F.lit(error)).write.mode("overwrite").json(
        f"{path}/{batch_folder(df.sparkSession, batch_id)}")


def with_dead_letter(fn: BatchFn, path: str, retries: int = 2) -> BatchFn:
    """Try a batch ``1 + retries`` times, then divert it and go on.

    The batch's rows are staged first, by the one time that its plan runs; attempts and the
    quarantine read them from there, so state moves once however often a sink fails. A plan
    that fails itself fails the query, which goes on from there when it starts again;
    ``intake.Intake`` keeps rows that would make it fail out of a stateful query.
    """

    def run(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        staged = storage.work_folder(spark, "batch")
        df.write.parquet(staged)
        rows = spark.read.schema(df.schema).parquet(staged)
        for attempt in range(retries + 1):
            try:
                fn(rows, batch_id)
                break
            except Exception as e:  # noqa: BLE001 - any failure is diverted
                log.warning("batch %s, attempt %s failed: %s", batch_id, attempt + 1, e)
                error = f"{type(e).__name__}: {e}"
        else:
            write_quarantine(rows, path, batch_id, error)
        storage.delete(spark, staged)

    return run


def split_corrupt(
    events: DataFrame, required: tuple[str, ...] = ("unieke_id",), corrupt_col: str | None = None
):
    """(usable, corrupt) events; corrupt ones lack a required field or were no record."""
    bad = F.lit(False) if corrupt_col is None else F.col(corrupt_col).isNotNull()
    for c in required:
        bad = bad | F.col(c).isNull()
    return events.where(~bad), events.where(bad)


@dataclass(frozen=True)
class TrafficSinks:
    """Writes each batch of ``stream_speed_profile`` to all sinks below ``root``.

    Append-only outputs go to ``run=<query>/batch=<id>`` folders and keyed tables
    to a version per batch, so a replayed batch overwrites itself, and a query
    with a new checkpoint adds to what earlier ones left. The lines of the archive and
    the dashboard repeat their field names, so their files are written compressed.
    """

    root: str
    locations: DataFrame
    compression: str = "gzip"

    def folder(self, name: str, batch_id: int | None = None) -> str:
        base = f"{self.root.rstrip('/')}/{name}"
        if batch_id is None:
            return base
        return f"{base}/{batch_folder(self.locations.sparkSession, batch_id)}"

    def __call__(self, profile: DataFrame, batch_id: int) -> None:
        # Stateful rows are computed once and then feed every sink.
        profile = output.enrich_location(profile, self.locations).persist(
            StorageLevel.MEMORY_AND_DISK)
        try:
            # Counting runs every partition, as the state commits need.
            if profile.count() == 0:
                return
            self._results(profile, batch_id)
            self._state(profile, batch_id)
            self._alerts(profile, batch_id)
        finally:
            profile.unpersist()

    def _results(self, profile: DataFrame, batch_id: int) -> None:
        results = queries.stream_traffic_output(profile)
        files.publish_results(results, self.folder("stream", batch_id), "overwrite")
        files.archive_results(
            results, self.folder("archive", batch_id), "overwrite", self.compression)
        files.write_dashboard(
            results, self.folder("dashboard", batch_id), "overwrite", self.compression)

    def _state(self, profile: DataFrame, batch_id: int) -> None:
        def variant(rows: DataFrame, tag: str) -> DataFrame:
            rows = rows.withColumnRenamed("speed", "currentSpeed")
            if "position" not in rows.columns:
                rows = rows.withColumn("position", F.lit(0).cast("long"))
            return rows.selectExpr(
                *output.variant(rows, tag).values(), "cast(position AS bigint) AS position")

        written = (
            variant(queries.speed_change_rows(profile), S.SPEED_DIFFERENTIAL)
            .unionByName(variant(queries.jam_change_rows(profile), S.TRAFFIC_JAM))
            .unionByName(variant(profile, S.SPEED_AVG))
        )
        newest = state.latest_per_key(
            written, S.STATE_KEYS, ["originalRecordTimestamp", "position"])
        tables.write_state(
            profile.sparkSession, self.folder("state"), output.to_state_item(newest), batch_id,
            run_of(profile.sparkSession))

    def _alerts(self, profile: DataFrame, batch_id: int) -> None:
        feed = jam_feed(profile)
        alerts = feed.select(
            "uniqueId", "recordTimestamp", "originalRecordTimestamp",
            F.col("new.trafficJamIndicator").cast("string").alias("alertIndicator"),
            F.col("new.loc").alias("loc"),
        )
        newest = state.latest_per_key(alerts, S.ALERT_KEYS, "originalRecordTimestamp")
        tables.write_alerts(
            profile.sparkSession, self.folder("alerts"),
            newest.select(*S.ALERT.fieldNames()), batch_id, run_of(profile.sparkSession))
        notes = changes.notifications(alert_feed(feed))
        files.write_notifications(notes, self.folder("notifications", batch_id), "overwrite")


def jam_feed(profile: DataFrame) -> DataFrame:
    """Change feed of the jam items: the old image comes from the state."""
    rows = queries.jam_change_rows(profile)
    old = F.when(
        F.col("storedJamIndicator").isNotNull(),
        F.struct(
            F.col("storedJamTimestamp").alias("recordTimestamp"),
            F.col("storedJamSpeed").alias("currentSpeed"),
            F.col("storedJamIndicator").alias("trafficJamIndicator"),
            F.col("location").alias("loc"),
        ),
    )
    new = F.struct(
        "recordTimestamp",
        F.col("speed").alias("currentSpeed"),
        "trafficJamIndicator",
        F.col("location").alias("loc"),
    )
    return rows.select(
        F.col("uniqueId").cast("string").alias("uniqueId"),
        "recordTimestamp", "originalRecordTimestamp", old.alias("old"), new.alias("new"))


def alert_feed(feed: DataFrame) -> DataFrame:
    """Feed of the alert table; each jam change is also an alert change."""

    def image(name: str):
        source = F.col(name)
        return F.when(
            source.isNotNull(),
            F.struct(
                source["trafficJamIndicator"].cast("string").alias("alertIndicator"),
                source["loc"].alias("loc"),
            ),
        ).alias(name)

    return feed.select("uniqueId", "recordTimestamp", image("old"), image("new"))
