"""Snapshot, station-configuration and raw-document readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanepulse import schemas as S
from lanepulse.functions import expressions as E
from lanepulse.functions import times


def file_reader(
    spark: SparkSession, stream: bool = False, glob: str | None = None, max_files: int | None = None,
    max_bytes: int | None = None,
):
    """Batch or file-stream reader with name selection and rate limits.

    The folder of the path is the prefix of the names, ``glob`` their suffix. A stream takes
    ``max_files`` files or files of ``max_bytes`` in all per micro-batch, oldest first.
    """
    reader = spark.readStream if stream else spark.read
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if stream and max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if stream and max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader


def modified_since(df: DataFrame, since_ms: int | None) -> DataFrame:
    """Rows of files that were modified at ``since_ms`` (epoch milliseconds) or later.

    Spark skips older files by their listing, without opening them.
    """
    if since_ms is None:
        return df
    return df.where(F.col("_metadata.file_modification_time") >= F.timestamp_millis(F.lit(since_ms)))


def _with_corrupt(schema: T.StructType, corrupt_col: str | None) -> T.StructType:
    if corrupt_col is None:
        return schema
    return T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType())])


def _xml_rows(reader, path, schema, corrupt_col=None):
    reader = reader.format("xml").option("rowTag", "meetpunt").option("attributePrefix", "@")
    if corrupt_col is not None:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    return reader.option("mode", "PERMISSIVE").schema(_with_corrupt(schema, corrupt_col)).load(path)


def read_snapshot_xml(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    *,
    glob: str | None = "*.xml",
    max_files: int | None = None,
    max_bytes: int | None = None,
    since_ms: int | None = None,
    corrupt_col: str | None = None,
) -> DataFrame:
    """One row per ``meetpunt`` of each snapshot below ``path``.

    With ``corrupt_col``, the text of an element that is not well formed is kept there.
    """
    rows = _xml_rows(file_reader(spark, stream, glob, max_files, max_bytes), path, S.SNAPSHOT_STATION, corrupt_col)
    return modified_since(rows, since_ms)


def read_station_config(
    spark: SparkSession, path: str, *, glob: str | None = "*.xml"
) -> DataFrame:
    """One row per ``meetpunt`` of a station configuration."""
    return _xml_rows(file_reader(spark, glob=glob), path, S.STATION_CONFIG)


def read_snapshot_json(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    *,
    glob: str | None = "*.json",
    max_files: int | None = None,
    max_bytes: int | None = None,
    since_ms: int | None = None,
    corrupt_col: str | None = None,
) -> DataFrame:
    """One row per entry of ``miv.meetpunt`` of each JSON snapshot.

    With ``corrupt_col``, a document that is no JSON is one row with its text there.
    """
    reader = file_reader(spark, stream, glob, max_files, max_bytes).option("multiLine", True)
    if corrupt_col is not None:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    docs = modified_since(reader.schema(_with_corrupt(S.SNAPSHOT_DOCUMENT, corrupt_col)).json(path), since_ms)
    if corrupt_col is None:
        return stations_of(docs)
    entries = F.when(F.col(corrupt_col).isNotNull(), F.array(F.lit(None).cast(S.SNAPSHOT_STATION))) \
        .otherwise(F.col("miv.meetpunt"))
    return docs.select(F.explode(entries).alias("m"), corrupt_col).select("m.*", corrupt_col)


def stations_of(documents: DataFrame) -> DataFrame:
    """Snapshot documents -> one row per station."""
    return documents.select(F.explode("miv.meetpunt").alias("m")).select("m.*")


def read_raw_documents(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    *,
    glob: str | None = "*.xml",
    max_files: int | None = None,
    since_ms: int | None = None,
    ingest_ms: int | None = None,
    prefix: str = "xml/input/",
) -> DataFrame:
    """Whole documents as they arrived, under an ingest-time name.

    Documents of one run share the time; a hash of the source file tells them apart.
    """
    docs = (
        modified_since(
            file_reader(spark, stream, glob, max_files).option("wholetext", True).text(path), since_ms)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )
    ms = times.now_epoch_millis(ingest_ms)
    source = F.substring(F.md5("source_file"), 1, 12)
    return docs.select(
        F.concat(F.lit(prefix), ms.cast("string"), F.lit("-"), source, F.lit(".xml")).alias("name"),
        ms.alias("ingest_ms"),
        "source_file",
        F.col("value").alias("document"),
    )


def with_landed_name(
    df: DataFrame,
    source_prefix: str = "xml/input/",
    target_prefix: str = "json/input/",
    suffix: str = ".json",
) -> DataFrame:
    """Add ``landed_name``: where the JSON of a snapshot file belongs."""
    path = F.col("_metadata.file_path")
    return df.withColumn(
        "landed_name", E.landed_name(path, source_prefix, target_prefix, suffix))
