"""Readers of flat events and of result records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lanepulse import schemas as S
from lanepulse.operators import output
from lanepulse.sources.snapshots import file_reader, modified_since


def read_events_jsonl(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    *,
    glob: str | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
    since_ms: int | None = None,
    corrupt_col: str | None = None,
) -> DataFrame:
    """Flat events, one JSON record per line, all fields as text.

    A line that is no JSON gives a row of NULLs; with ``corrupt_col`` its text
    is kept in that column, for the quarantine. ``since_ms`` leaves
    out files that were modified before (``intake.start_bound``: start at the latest).
    """
    reader = file_reader(spark, stream, glob, max_files, max_bytes)
    schema = S.FLAT_EVENT
    if corrupt_col is not None:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    return modified_since(reader.schema(schema).json(path), since_ms)


def read_results(source: DataFrame, value: str = "value") -> DataFrame:
    """Decode result records from any stream or table with a value column."""
    return output.decode_results(source, value)


def read_results_archive(
    spark: SparkSession, path: str, stream: bool = False
) -> DataFrame:
    """The archived result records (JSON lines)."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(S.RESULT).json(path)
