"""Keyed tables without a merge-capable format.

Each write makes a new version folder ``v=<n>``, named after the run and batch that
wrote it; readers take the newest one that is finished. A batch that is replayed
rewrites its own version from the one before, so a lost executor or a restarted
query changes nothing. Numbers go on rising when another run begins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanepulse import schemas as S
from lanepulse import storage
from lanepulse.sources import tables

KEEP_VERSIONS = 3


def merge_latest(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same key.

    ``new`` holds one row per key. Aggregates before the shuffle.
    """
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    values = [c for c in old.columns if c not in keys]
    picked = F.max_by(F.struct(*values), F.col("_new")).alias("_v")
    return both.groupBy(*keys).agg(picked).select(*keys, "_v.*").select(*old.columns)


def _target(known: list[storage.Version], run: str, batch: int | None) -> storage.Version | None:
    """The version a batch writes; none if a later batch of its run is in the table.

    Numbers rise over all runs. A batch that is replayed writes its own version
    again, if nothing was built on it.
    """
    number = known[-1].number + 1 if known else 0
    if batch is None:
        return storage.Version(number, "", None)
    for v in known:
        if v.run == run and v.batch is not None and v.batch >= batch:
            return v if v.batch == batch and v == known[-1] else None
    return storage.Version(number, run, batch)


def write_keyed(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    keys: Sequence[str],
    schema: T.StructType,
    batch_id: int | None = None,
    run: str = "",
) -> int | None:
    """Merge ``rows`` into the keyed table; returns the version written.

    ``run`` names the streaming query (its checkpoint) that counts the batches, so a
    query that begins anew over an existing table goes on from its newest version.
    """
    target = _target(storage.version_list(spark, path), run, batch_id)
    if target is None:
        return None
    old = tables.scan_keyed(spark, path, schema, before=target.number)
    new = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    merge_latest(old, new, keys).write.mode("overwrite").parquet(f"{path}/{target.folder}")
    for stale in storage.version_list(spark, path)[:-KEEP_VERSIONS]:
        storage.delete(spark, f"{path}/{stale.folder}")
    return target.number


def write_state(
    spark: SparkSession, path: str, items: DataFrame, batch_id: int | None = None, run: str = ""
) -> int | None:
    """Merge state items (one per sensor and variant) into the state table."""
    return write_keyed(spark, path, items, S.STATE_KEYS, S.STATE, batch_id, run)


def write_alerts(
    spark: SparkSession, path: str, alerts: DataFrame, batch_id: int | None = None, run: str = ""
) -> int | None:
    """Merge alert rows (one per sensor) into the alert table."""
    return write_keyed(spark, path, alerts, S.ALERT_KEYS, S.ALERT, batch_id, run)


def clear_table(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """Empty a keyed table by an empty next version.

    Readers see the full table or the empty one, and later batches build on the
    empty one.
    """
    known = storage.version_list(spark, path)
    version = known[-1].number + 1 if known else 0
    spark.createDataFrame([], schema).write.parquet(f"{path}/v={version}")
    for stale in known:
        storage.delete(spark, f"{path}/{stale.folder}")
    return version
