"""Readers of the location table and of the keyed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lanepulse import schemas as S
from lanepulse import storage


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """Location table: tab separated, with a header line."""
    return (
        spark.read.option("sep", "\t").option("header", True)
        .option("enforceSchema", True).schema(S.LOCATION).csv(path)
    )


def scan_keyed(
    spark: SparkSession, path: str, schema: T.StructType, before: int | None = None
) -> DataFrame:
    """Newest finished version of a keyed table; empty if there is none.

    ``before`` asks for the newest version older than the given one.
    """
    known = [v for v in storage.version_list(spark, path) if before is None or v.number < before]
    if not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{known[-1].folder}")


def scan_state(spark: SparkSession, path: str) -> DataFrame:
    """All items of the latest-state table."""
    return scan_keyed(spark, path, S.STATE)


def scan_alerts(spark: SparkSession, path: str) -> DataFrame:
    """All items of the alert table."""
    return scan_keyed(spark, path, S.ALERT)


def scan_keys(table: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Keys only; a columnar source reads no other column."""
    return table.select(*key_cols)
