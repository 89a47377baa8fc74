"""The streaming operators, run over ``events`` until all is processed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanepulse import schemas as S
from lanepulse import storage
from lanepulse.functions import times
from lanepulse.plans import adapters as A
from lanepulse.sources import events, tables
from lanepulse.streaming import batches, queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

WINDOWS = {k: A.WINDOWS[k] for k in ("short", "long")}
DELAY_SECONDS = 600


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def measurement_stream(spark: SparkSession, sf_dir: str, of: Column | None = None) -> DataFrame:
    """``events`` as a file stream of measurements, closed by one far row.

    Instants newer than the final watermark would stay in state. A row made
    from the newest reading, later than any other, moves the watermark past
    all of them; it stays behind in state itself. ``of`` is a condition on the
    measurements; what it does not need is left out before it is parsed.
    """
    static = A.table(spark, sf_dir, "events")
    newest = static.agg(F.max("ts")).first()[0]
    source = spark.readStream.schema(static.schema).option(
        "pathGlobFilter", "events.parquet").parquet(sf_dir)
    rows = source.select(
        F.col("user_id").cast("int").alias("uniqueId"),
        F.floor("value").cast("int").alias("speed"),
        F.get_json_object("props", "$.k").cast("int").alias("bezettingsgraad"),
        times.as_utc_instant(source, "ts").alias("recordTimestamp"),
        (F.col("ts") == F.lit(newest).cast("timestamp_ntz")).alias("newest"),
    )
    if of is not None:
        # a filter behind the explode is not moved to the source
        rows = rows.where(of | F.col("newest"))
    row = F.struct("uniqueId", "speed", "bezettingsgraad", "recordTimestamp")
    after = F.struct(
        F.lit(-1).alias("uniqueId"),
        F.lit(None).cast("int").alias("speed"),
        F.lit(None).cast("int").alias("bezettingsgraad"),
        (F.col("recordTimestamp") + F.expr(f"INTERVAL {DELAY_SECONDS + 1} SECOND"))
        .alias("recordTimestamp"),
    )
    both = F.when(F.col("newest"), F.array(row, after)).otherwise(F.array(row))
    found = rows.select(F.explode(both).alias("r")).select("r.*")
    return found if of is None else found.where(of)


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries.stream_speed_profile(
        measurement_stream(spark, sf_dir), delay=f"{DELAY_SECONDS} seconds", **WINDOWS)


def run(sdf: DataFrame, purpose: str) -> DataFrame:
    """Process everything, batch by batch, and return the written table."""
    spark = sdf.sparkSession
    folder = storage.work_folder(spark, purpose)
    table = f"{folder}/table"

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    queries.start(sdf, sink, f"{folder}/checkpoint", trigger=None).awaitTermination()
    return spark.read.schema(sdf.schema).parquet(f"{table}/batch=*")


def _with_wall_clock(df: DataFrame) -> DataFrame:
    """Back to the zone-less times of the source table."""
    return df.withColumn(
        "originalRecordTimestamp",
        times.utc_wall_clock(F.unix_micros("originalRecordTimestamp")))


@query
def stream_speed_profile(spark, d):
    rows = queries.stream_readings(_profile(spark, d)).select(
        "uniqueId", "speed", "bezettingsgraad", "recordTimestamp", "avgSpeed3Minutes",
        "avgSpeed10Minutes", "originalRecordTimestamp")
    return _with_wall_clock(run(rows, "stream-profile"))


@query
def stream_previous_speed(spark, d):
    rows = queries.stream_previous_speed(
        measurement_stream(spark, d), delay=f"{DELAY_SECONDS} seconds", **WINDOWS)
    return _with_wall_clock(run(rows, "stream-previous"))


@query
def stream_traffic_output(spark, d):
    rows = queries.stream_traffic_output(_profile(spark, d), A.locations(spark, d))
    return _with_wall_clock(run(rows, "stream-output"))


@query
def stream_jam_change_points(spark, d):
    rows = queries.jam_change_rows(_profile(spark, d)).select(
        "uniqueId", "originalRecordTimestamp", F.col("speed").alias("currentSpeed"),
        "trafficJamIndicator")
    return _with_wall_clock(run(rows, "stream-jam"))


@query
def stream_speed_change_points(spark, d):
    rows = queries.speed_change_rows(_profile(spark, d)).select(
        "uniqueId", "originalRecordTimestamp", "previousSpeed",
        F.col("speed").alias("currentSpeed"), "speedDiffIndicator", "bezettingsgraad")
    return _with_wall_clock(run(rows, "stream-change"))


def _run_sinks(spark: SparkSession, sf_dir: str) -> batches.TrafficSinks:
    folder = storage.work_folder(spark, "stream-sinks")
    sinks = batches.TrafficSinks(f"{folder}/out", A.locations(spark, sf_dir))
    guarded = batches.with_dead_letter(sinks, f"{folder}/quarantine")
    queries.start(
        _profile(spark, sf_dir), guarded, f"{folder}/checkpoint", trigger=None
    ).awaitTermination()
    return sinks


@query
def stream_state_table(spark, d):
    """The state table as the streaming sinks leave it."""
    return tables.scan_state(spark, _run_sinks(spark, d).folder("state"))


@query
def stream_notifications(spark, d):
    """The notification table as the streaming sinks leave it."""
    folder = _run_sinks(spark, d).folder("notifications")
    return spark.read.schema(S.NOTIFICATION).parquet(f"{folder}/run=*/batch=*")


@query
def stream_restart(spark, d):
    """The state table after two queries, each with its own checkpoint, one after the other."""
    folder = storage.work_folder(spark, "stream-restart")
    sinks = batches.TrafficSinks(f"{folder}/out", A.locations(spark, d))
    for half in (0, 1):
        rows = measurement_stream(
            spark, d, (F.col("uniqueId") == -1) | (F.pmod("uniqueId", F.lit(2)) == half))
        profile = queries.stream_speed_profile(rows, delay=f"{DELAY_SECONDS} seconds", **WINDOWS)
        queries.start(profile, sinks, f"{folder}/checkpoint-{half}", trigger=None).awaitTermination()
    return tables.scan_state(spark, sinks.folder("state"))


@query
def stream_null_sensor(spark, d):
    """Readings of some sensors without their id: a group of their own, as in batch."""
    stream = measurement_stream(spark, d).withColumn(
        "uniqueId", F.when(F.pmod("uniqueId", F.lit(10)) != 3, F.col("uniqueId")))
    profile = queries.stream_speed_profile(stream, delay=f"{DELAY_SECONDS} seconds", **WINDOWS)
    rows = queries.stream_readings(profile).select(
        "uniqueId", "speed", "bezettingsgraad", "recordTimestamp", "avgSpeed3Minutes",
        "avgSpeed10Minutes", "originalRecordTimestamp")
    return _with_wall_clock(run(rows, "stream-null-sensor"))


@query
def stream_outputs_agree(spark, d):
    """Both outputs of the batches, live and archived, hold the same records."""
    sinks = _run_sinks(spark, d)
    live = events.read_results(
        spark.read.parquet(f"{sinks.folder('stream')}/run=*/batch=*"))
    kept = events.read_results_archive(spark, f"{sinks.folder('archive')}/run=*/batch=*")
    both = live.withColumn("n", F.lit(1)).unionByName(kept.withColumn("n", F.lit(-1)))
    return both.groupBy(*S.RESULT_COLUMNS).agg(F.sum("n").alias("n"), F.count("*").alias("rows")).groupBy(
        "outputType").agg(F.sum("rows").alias("records"), F.count_if(F.col("n") != 0).alias("differ"))
