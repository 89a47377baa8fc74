"""File sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanepulse import schemas as S
from lanepulse import storage
from lanepulse.operators import output, stations

#: Result lines are mostly field names, which the fastest level of gzip packs well enough.
FAST = {"zlib.compress.level": "BEST_SPEED"}
#: Bytes of a row group of published texts, so that several tasks can share a large file.
ROW_GROUP = 8 << 20


def land_json(df: DataFrame, path: str, mode: str = "append", compression: str = "none") -> None:
    """Snapshot stations as JSON, next to the name of their source file.

    ``df`` needs a ``landed_name`` column (``sources.with_landed_name``); it
    becomes the partition folder, so each source file has its own place.
    """
    df.write.mode(mode).option("compression", compression).partitionBy("landed_name").json(path)


def land_raw(documents: DataFrame, path: str, mode: str = "append") -> None:
    """Raw documents (``sources.read_raw_documents``) as a bronze table."""
    documents.write.mode(mode).parquet(path)


def publish_events(
    df: DataFrame, path: str, group: int | None = None, mode: str = "append"
) -> None:
    """Flat events as JSON records.

    ``group`` limits the records per file, as a sender that puts groups of 100
    would. It is no part of the meaning; by default Spark sets the file sizes.
    """
    writer = df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode(mode)
    if group is not None:
        writer = writer.option("maxRecordsPerFile", group)
    writer.text(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    """Append events as JSON lines."""
    df.write.mode("append").json(path)


def publish_results(results: DataFrame, path: str, mode: str = "append") -> None:
    """Result records for the live consumers: one JSON text per row."""
    output.encode_results(results).write.mode(mode).option("parquet.block.size", ROW_GROUP).parquet(path)


def archive_results(
    results: DataFrame, path: str, mode: str = "append", compression: str = "none"
) -> None:
    """Result records as JSON lines, for later ad-hoc queries."""
    output.exact_times(results).select(*S.RESULT_COLUMNS).write.mode(mode).options(
        compression=compression, **FAST, **output.TIME_OPTIONS).json(path)


def write_notifications(notes: DataFrame, path: str, mode: str = "append") -> None:
    """(message, incoming) rows; sending them on is the caller's job."""
    notes.select("message", "incoming").write.mode(mode).parquet(path)


def dashboard_payload(results: DataFrame) -> DataFrame:
    """Each dashboard row as a JSON list of one object.

    The brackets are put around the object: inside an array, ``to_json`` walks a linked
    list of writers anew for each field of a row.
    """
    rows = output.dashboard_rows(results)
    return rows.select(
        F.concat(F.lit("["), F.to_json(F.struct(*rows.columns)), F.lit("]")).alias("value"))


def write_dashboard(
    results: DataFrame, path: str, mode: str = "append", compression: str = "none"
) -> None:
    """Dashboard feed, one payload per line."""
    dashboard_payload(results).write.mode(mode).options(compression=compression, **FAST).text(path)


def write_locations(locations: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Location table, tab separated with header."""
    locations.write.mode(mode).option("sep", "\t").option("header", True).csv(path)


def write_geojson(cfg: DataFrame, path: str, ids: Sequence[str], mode="overwrite") -> None:
    """FeatureCollection of the listed stations, one document."""
    stations.geojson_collection(cfg, ids).write.mode(mode).text(path)


def dump_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """All rows as JSON lines, integral numbers without a fraction."""
    df.write.mode(mode).json(path)


def register_views(
    spark: SparkSession, events_path: str, results_path: str,
    events_view: str = "raw_events", results_view: str = "results",
) -> None:
    """Archived events and results as temporary views of the session."""
    spark.read.schema(S.FLAT_EVENT).json(events_path).createOrReplaceTempView(events_view)
    spark.read.schema(S.RESULT).json(results_path).createOrReplaceTempView(results_view)


def archive_by_day(
    df: DataFrame, path: str, time: Column, run: str, batch: int, mode: str = "overwrite"
) -> None:
    """JSON lines below ``day=<UTC day>/run=<query>/batch=<id>``.

    A batch that runs again replaces its own folders and no others. Rows without a time go
    to the day ``__HIVE_DEFAULT_PARTITION__``.
    """
    day = F.date_from_unix_date(F.floor(F.unix_micros(time) / 86_400_000_000).cast("int"))
    rows = df.withColumns({"day": day, "run": F.lit(run), "batch": F.lit(batch).cast("long")})
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").options(**output.TIME_OPTIONS) \
        .partitionBy("day", "run", "batch").json(path)


def read_archive(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An archive by day, with ``day``: a condition on it leaves out folders, unopened."""
    parts = [T.StructField("day", T.DateType()), T.StructField("run", T.StringType()),
             T.StructField("batch", T.LongType())]
    return spark.read.schema(T.StructType([*schema.fields, *parts])).json(path).drop("run", "batch")


def compact_day(spark: SparkSession, path: str, day: str, files: int = 1) -> None:
    """Replaces the small files of a day by ``files`` larger ones; the rows stay the same.

    For days that get no more rows. The new files are written beside the day and take its
    place by a rename, so a reader that lists the folder meanwhile may miss the day, but
    never sees a row twice.
    """
    folder = f"{path.rstrip('/')}/day={day}"
    beside = f"{path.rstrip('/')}/_compact/day={day}"
    spark.read.option("recursiveFileLookup", True).text(folder).repartition(files) \
        .write.mode("overwrite").text(f"{beside}/run=compact/batch=0")
    storage.move(spark, beside, folder)
