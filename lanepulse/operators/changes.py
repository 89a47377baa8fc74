"""Writes on change, change feed, alerts and notifications."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanepulse import schemas as S
from lanepulse.functions import expressions as E
from lanepulse.operators import slices

SLICE_SECONDS = 4 * 3600


def _sliced(df: DataFrame, order: Sequence[str], slice_col: str | None) -> tuple[DataFrame, str]:
    """``df`` with a slice column that grows with the first order column.

    A column made by the window operators is used as it is, so that their
    partitioning is kept. Otherwise epoch milliseconds or timestamps are cut
    into slices of four hours.
    """
    if slice_col is not None:
        return df, slice_col
    first = order[0]
    if df.schema[first].dataType.typeName().startswith("timestamp"):
        number = slices.slice_number(df, first, SLICE_SECONDS)
    else:
        number = F.floor(F.col(first).cast("bigint") / F.lit(SLICE_SECONDS * 1000))
    return df.withColumn(slices.SLICE, number), slices.SLICE


def change_points(
    df: DataFrame,
    keys: Sequence[str],
    flag: str,
    order: Sequence[str],
    *,
    slice_col: str | None = None,
    also: Column | None = None,
) -> DataFrame:
    """Rows whose flag differs from the previous row of the same key.

    The first row of a key always counts: a condition ``<>`` on an item that
    does not exist yet holds. ``order`` must be unique per key. Of the rows
    that meet ``also``, the first and last of each slice are kept as well.
    """
    columns = df.columns
    df, by = _sliced(df, order, slice_col)
    differs = F.col("_inner").isNull() | ~F.col("_inner")["f"].eqNullSafe(F.col(flag))
    seen = slices.previous_in_slices(
        df, keys, order, F.struct(F.col(flag).alias("f")), "_before", by, keep=differs)
    before = F.col("_before")
    kept = before.isNull() | ~before["f"].eqNullSafe(F.col(flag))
    if also is not None:
        kept = kept | also
    return seen.where(kept).select(*columns)


def change_feed(
    versions: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    slice_col: str | None = None,
) -> DataFrame:
    """Versions of keyed rows -> keys, order columns, old image, new image."""
    attributes = [c for c in versions.columns if c not in keys and c != slices.SLICE]
    versions, by = _sliced(versions, order, slice_col)
    image = F.struct(*attributes)
    seen = slices.previous_in_slices(versions, keys, order, image, "old", by)
    rest = [c for c in order if c not in keys]
    return seen.select(*keys, *rest, "old", image.alias("new"))


def jam_changes(feed: DataFrame) -> DataFrame:
    """Feed entries that have a new image carrying the jam flag."""
    return feed.where(
        F.col("new").isNotNull() & F.col("new.trafficJamIndicator").isNotNull())


def alert_versions(
    feed: DataFrame, order: Sequence[str] = ("recordTimestamp",)
) -> DataFrame:
    """Versions of the alert table: the jam flag as text, when it changes."""
    alerts = jam_changes(feed).select(
        F.col("uniqueId").cast("string").alias("uniqueId"),
        *order,
        F.col("new.trafficJamIndicator").cast("string").alias("alertIndicator"),
        F.col("new.loc").alias("loc"),
    )
    return change_points(alerts, S.ALERT_KEYS, "alertIndicator", order)


def notifications(
    alert_feed: DataFrame, order: Sequence[str] = ("recordTimestamp",)
) -> DataFrame:
    """Alert feed -> messages: a new jam always, its end only after a start.

    "After a start" means that an older image exists, whatever its flag. A
    sensor without a location is named by its id.
    """
    flag = F.col("new.alertIndicator")
    place = F.coalesce(F.col("new.loc"), F.col("uniqueId").cast("string"))
    raised = (flag == "1") | ((flag == "0") & F.col("old").isNotNull())
    return alert_feed.where(raised).select(
        "uniqueId",
        *order,
        E.jam_message(flag, place).alias("message"),
        (flag == "1").alias("incoming"),
    )


def table_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change feed between two versions of a keyed table: keys, ``change``, old and new image.

    Each version has one row per key. ``change`` is insert, update or delete; an image is
    null where there is none, and keys with equal images are left out. One shuffle of each
    version, none if they are bucketed by the keys.
    """
    values = [c for c in after.columns if c not in keys]

    def imaged(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(*values).alias(name))

    both = imaged(before, "old").join(imaged(after, "new"), list(keys), "full_outer")
    change = F.when(F.col("old").isNull(), "insert").when(F.col("new").isNull(), "delete").otherwise("update")
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select(*keys, change.alias("change"), "old", "new")
