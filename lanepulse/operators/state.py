"""Latest state per key, and the read views on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanepulse import schemas as S
from lanepulse.operators import changes


def distinct_ids(state: DataFrame, id_col: str = "uniqueId") -> DataFrame:
    return state.select(id_col).distinct()


def count_rows(df: DataFrame) -> DataFrame:
    """Number of rows, as a one-row DataFrame ``n``."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def flag_count(
    state: DataFrame, flag: str, value: int, id_col: str = "uniqueId"
) -> DataFrame:
    """Number of rows per sensor whose flag has the given value."""
    return (
        state.where(F.col(flag) == value).groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    )


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: str | Sequence[str]
) -> DataFrame:
    """The newest row of each key. Aggregates before the shuffle."""
    order = [order] if isinstance(order, str) else list(order)
    values = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*values), F.struct(*order))
    return df.groupBy(*keys).agg(newest.alias("_v")).select(*keys, "_v.*").select(*df.columns)


def collapse_results(results: DataFrame) -> DataFrame:
    """Archived results without their copies, in an order that can be relied on.

    Copies of one instant are equal but for the first speed-change record.
    ``position`` puts that one first, so that (time, position) is unique per
    key. Duplicates are merged before the shuffle.
    """
    follows = (
        (F.col("outputType") == S.SPEED_DIFFERENTIAL)
        & F.col("previousSpeed").eqNullSafe(F.col("currentSpeed"))
    )
    return results.dropDuplicates().withColumn("position", F.when(follows, 1).otherwise(0))


def latest_state(
    results: DataFrame,
    order: Sequence[str] = ("originalRecordTimestamp", "recordTimestamp", "position"),
    slice_col: str | None = None,
) -> DataFrame:
    """What the state table holds after all results were written.

    Averages are overwritten each time. The two flags are written only when
    they change, so their row is the last change point, not the newest result.
    The order must be unique per key; see ``collapse_results`` for an archive.
    """
    order = [c for c in order if c in results.columns]
    average = F.col("outputType") == S.SPEED_AVG
    flag = (
        F.when(F.col("outputType") == S.SPEED_DIFFERENTIAL, F.col("speedDiffIndicator"))
        .when(F.col("outputType") == S.TRAFFIC_JAM, F.col("trafficJamIndicator"))
    )
    # One pass for all three: averages have no flag, and the newest one is the
    # last row of its slice.
    versions = changes.change_points(
        results.withColumn("_flag", flag), S.STATE_KEYS, "_flag", order,
        slice_col=slice_col, also=average)
    return latest_per_key(versions.drop("_flag"), S.STATE_KEYS, order)


def lookup(
    state: DataFrame, output_type: str, sensor: str | int | None, col: str, value: int
) -> DataFrame:
    """State rows of a variant whose flag has the given value.

    ``sensor`` names one sensor; ``None`` looks at all.
    """
    rows = state.where((F.col("outputType") == output_type) & (F.col(col) == value))
    return rows if sensor is None else rows.where(F.col("uniqueId") == sensor)


def current_situation(state: DataFrame) -> DataFrame:
    """One row per sensor with its items, one per variant, in fixed order.

    Built by conditional aggregation: a sensor can hold no more than one item
    per variant, and no list of unknown length is collected. An item whose
    time is no number stays; it is older than any other.
    """
    item = F.struct(*state.columns)
    at = F.coalesce(F.col("recordTimestamp").try_cast("bigint"), F.lit(-(2**63)))
    picks = [
        F.max_by(item, F.when(F.col("outputType") == t, at)).alias(t) for t in S.OUTPUT_TYPES
    ]
    return state.groupBy("uniqueId").agg(*picks).select(
        "uniqueId", F.array_compact(F.array(*S.OUTPUT_TYPES)).alias("items"))


def current_situation_json(state: DataFrame) -> DataFrame:
    """One ``{sensor: [items]}`` JSON entry per sensor."""
    return current_situation(state).select(
        "uniqueId",
        F.to_json(F.create_map(F.col("uniqueId").cast("string"), F.col("items"))).alias("entry"),
    )


def current_alerts_json(alerts: DataFrame) -> DataFrame:
    """One JSON entry per alert row."""
    return alerts.select(
        "uniqueId", F.to_json(F.struct(*S.ALERT.fieldNames())).alias("entry"))
