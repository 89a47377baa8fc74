"""The analytics as streaming transforms, and the triggers that drive them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lanepulse import schemas as S
from lanepulse.functions import times
from lanepulse.operators import output, windows
from lanepulse.streaming.processor import BUCKETS, NO_SENSOR, PROFILE, SpeedProcessor

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
# Counting a store's rows costs a lookup per row written or removed.
COUNT_ROWS = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Settings for queries started inside; the old ones are put back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def stream_speed_profile(
    sdf: DataFrame,
    *,
    delay: str = "10 minutes",
    short: int = windows.SHORT_SECONDS,
    long: int = windows.LONG_SECONDS,
    low: int = 40,
    high: int = 250,
    threshold: int = 20,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Sliding averages, previous speed and both flags, per sensor and instant.

    ``sdf`` has the columns of ``clean_input``. An instant is emitted once the
    watermark (``delay`` behind the newest event) has passed it; readings that
    come later still are dropped, and so are readings without a time, which
    have no place in the order. Sensors share ``buckets`` rows of state by a hash;
    a task holds one bucket at a time.
    """
    timed = sdf.where(F.col("recordTimestamp").isNotNull()).withWatermark(
        "recordTimestamp", delay)
    instants = windows.collapse_instants(timed)
    return (
        instants.withColumn("us", F.unix_micros("ts"))
        .withColumn("sensor", F.coalesce(F.col("uniqueId").cast("long"), F.lit(NO_SENSOR)))
        .withColumn("bucket", F.pmod(F.xxhash64("sensor"), F.lit(buckets)))
        .drop("ts", "uniqueId")
        .groupBy("bucket")
        .transformWithStateInPandas(
            SpeedProcessor(short, long, low, high, threshold),
            outputStructType=PROFILE,
            outputMode="Append",
            timeMode="None",
        )
        .withColumns({
            "recordTimestamp": F.expr("recordMicros div 1000"),
            "originalRecordTimestamp": F.timestamp_micros("recordMicros"),
        })
    )


def once_per_reading(sdf: DataFrame, keys: Sequence[str], delay: str) -> DataFrame:
    """Readings without those that a sender repeats within ``delay``."""
    return sdf.withWatermark("recordTimestamp", delay).dropDuplicatesWithinWatermark(list(keys))


def stream_tumbling(sdf: DataFrame, width: str = "2 minutes", delay: str = "10 minutes") -> DataFrame:
    """Average speed and occupancy per sensor and window of fixed length, once it is closed.

    A window starts anew each ``width`` since 1970-01-01 UTC; readings without a time have none.
    """
    timed = sdf.where(F.col("recordTimestamp").isNotNull()).withWatermark("recordTimestamp", delay)
    grouped = timed.groupBy(F.window("recordTimestamp", width).alias("w"), "uniqueId").agg(
        F.sum("speed").alias("speed"), F.count("speed").alias("n"), F.sum("bezettingsgraad").alias("occupancy"),
        F.count("bezettingsgraad").alias("m"), F.count(F.lit(1)).alias("readings"))
    return grouped.select(
        "uniqueId", F.col("w.start").alias("windowStart"), F.expr("int(speed div nullif(n, 0))").alias("avgSpeed"),
        F.expr("int(occupancy div nullif(m, 0))").alias("avgOccupancy"), "readings")


def with_times(sdf: DataFrame, event_time: str = "recordTimestamp", now_ms: int | None = None) -> DataFrame:
    """The times of a row of a file stream: event, arrival (of its file) and processing, and the lags in ms.

    ``now_ms`` fixes the processing time for repeatable runs.
    """
    arrived = F.unix_millis("_metadata.file_modification_time")
    timed = sdf.withColumns({"arrivalMillis": arrived, "processingMillis": times.now_epoch_millis(now_ms)})
    return timed.withColumns({
        "arrivalLag": F.col("arrivalMillis") - F.unix_millis(event_time),
        "processingLag": F.col("processingMillis") - F.col("arrivalMillis")})


def lag_quantiles(timed: DataFrame, at: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """One row: readings, and quantiles of both lags; for the batches of ``with_times``."""
    return timed.agg(F.count(F.lit(1)).alias("readings"), *(
        F.percentile_approx(c, list(at)).alias(f"{c}Quantiles") for c in ("arrivalLag", "processingLag")))


def observe_arrivals(sdf: DataFrame, name: str = "arrivals") -> DataFrame:
    """Count readings and untimed ones per batch; the query's progress shows them.

    Readings behind the watermark show there as ``numRowsDroppedByWatermark``.
    """
    return sdf.observe(
        name,
        F.count(F.lit(1)).alias("readings"),
        F.count_if(F.col("recordTimestamp").isNull()).alias("untimed"),
    )


def stream_previous_speed(sdf: DataFrame, **options) -> DataFrame:
    """Each reading next to the one before it, continuously."""
    return windows.previous_speed(stream_readings(stream_speed_profile(sdf, **options)))


def stream_readings(profile: DataFrame, at_most: int | None = None) -> DataFrame:
    """One row per reading; flags of further copies are those of no change."""
    rows = windows.repeat_copies(profile, at_most)
    later = F.col("position") > 0
    flag = F.when(later, 0).otherwise(F.col("speedDiffIndicator"))
    before = (
        F.when(F.col("position") == 0, F.col("storedDiffIndicator"))
        .when(F.col("position") == 1, F.col("speedDiffIndicator"))
        .otherwise(0)
    )
    return rows.withColumns({
        "storedDiffIndicator": before,
        "speedDiffIndicator": flag,
    })


def stream_traffic_output(
    profile: DataFrame, locations: DataFrame | None = None
) -> DataFrame:
    """The tagged result stream."""
    return output.traffic_output(stream_readings(profile), locations).select(*S.RESULT_COLUMNS)


def jam_change_rows(profile: DataFrame) -> DataFrame:
    """Instants whose jam flag differs from the stored one."""
    return profile.where(
        ~F.col("trafficJamIndicator").eqNullSafe(F.col("storedJamIndicator")))


def speed_change_rows(profile: DataFrame) -> DataFrame:
    """Readings whose speed-change flag differs from the stored one."""
    return stream_readings(profile, at_most=2).where(
        ~F.col("speedDiffIndicator").eqNullSafe(F.col("storedDiffIndicator")))


def start(
    sdf: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    trigger: str | None = "10 seconds",
    partitions: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Run ``sink`` on each micro-batch.

    ``trigger`` is the batch interval; ``None`` processes what is there and
    stops. Rows per batch are limited at the source (``max_files``). State has
    one partition per core unless ``partitions`` says otherwise; a checkpoint
    keeps the number it began with. Rows in state are not counted, so the
    query's progress does not show ``numRowsTotal``.
    """
    spark = sdf.sparkSession
    writer = sdf.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    writer = (
        writer.trigger(availableNow=True) if trigger is None
        else writer.trigger(processingTime=trigger)
    )
    number = partitions or spark.sparkContext.defaultParallelism
    with settings(spark, {PROVIDER: ROCKSDB, CHANGELOG: "true", COUNT_ROWS: "false", PARTITIONS: str(number)}):
        return writer.start()


def archive_events(
    sdf: DataFrame, path: str, checkpoint: str, *, trigger: str | None = "60 seconds"
) -> StreamingQuery:
    """All events, before any filter, as JSON lines below ``path``."""
    writer = (
        sdf.writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    writer = (
        writer.trigger(availableNow=True) if trigger is None
        else writer.trigger(processingTime=trigger)
    )
    return writer.start()


def measurements_from(df: DataFrame, ts: str) -> DataFrame:
    """Replace a zone-less time column by the instant it names in UTC."""
    return df.withColumn(ts, times.as_utc_instant(df, ts))
