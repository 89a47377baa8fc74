"""Time slices: how per-sensor windows stay small when a sensor is large.

A window partitioned by sensor alone puts a sensor's whole history into one
task. Here a partition is (sensor, slice of time) instead. Rows that a later
slice looks back to are copied into it, so each slice can be computed on its
own and the result is the same as without slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanepulse.functions import times

SLICE = "_slice"


def slice_number(df: DataFrame, ts: str, seconds: int) -> Column:
    """Number of the slice a row lies in; NULL for rows without a time."""
    return F.expr(f"floor({times.epoch_seconds_sql(df, ts)} / {seconds})")


def with_lookback(
    df: DataFrame, key: str, ts: str, seconds: int, reach: int
) -> DataFrame:
    """Place each row in its slice and in the later ones that look back to it.

    ``df`` holds one row per (key, ts). Adds the slice number and ``_own``,
    false for the copies. Each slice also gets the last row before it, however
    old, so that LAG works across silent periods.
    """
    second = times.epoch_seconds_sql(df, ts)
    home = f"floor({second} / {seconds})"
    reached = f"floor(({second} + {reach}) / {seconds})"
    placed = df.selectExpr(
        "*", f"{home} AS _home", f"explode_outer(sequence({home}, {reached})) AS {SLICE}"
    ).selectExpr(*df.columns, SLICE, f"_home <=> {SLICE} AS _own")

    # All columns go along, though LAG needs few: with the same columns on
    # both branches Spark reads the shuffle of ``df`` twice, not the source.
    # Rows without a time come first, as in any ascending order.
    age = f"coalesce({times.epoch_micros_sql(df, ts)}, {-(2**63) + 1}L)"
    values = [c for c in df.columns if c not in (key, ts)]
    closing = (
        df.selectExpr("*", f"{home} AS _home", f"{age} AS _age")
        .groupBy(key, "_home")
        .agg(
            F.expr(f"max({ts}) AS {ts}"),
            *[F.expr(f"max_by({c}, _age) AS {c}") for c in values],
        )
    )
    carried = (
        closing.selectExpr(
            *df.columns, f"lead(_home) OVER (PARTITION BY {key} ORDER BY _home) AS {SLICE}",
            "false AS _own")
        .where(f"{SLICE} > coalesce({reached}, {SLICE} - 1)")
    )
    return placed.unionByName(carried)


def previous_in_slices(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    slice_col: str = SLICE,
    keep: Column | None = None,
) -> DataFrame:
    """LAG(value) per key, computed slice by slice.

    Inside a slice the previous row is at hand. Only the first row of a slice
    needs the last one of an earlier slice, so first and last rows meet in a
    second, small window: two rows per (key, slice) at most. ``keep`` may name
    the rows worth passing on, in terms of ``_inner``; first and last rows
    always pass.
    """
    within = Window.partitionBy(*keys, slice_col).orderBy(*order)
    df = df.withColumns({
        "_inner": F.lag(value).over(within),
        "_first": F.row_number().over(within) == 1,
        "_last": F.lead(F.lit(1)).over(within).isNull(),
    })
    edge = F.col("_first") | F.col("_last")
    if keep is not None:
        df = df.where(edge | keep)
    group = F.when(~edge, F.col(slice_col))
    df = df.withColumns({"_edge": edge, "_group": group})
    across = Window.partitionBy(*keys, "_edge", "_group").orderBy(*order)
    previous = F.when(F.col("_first"), F.lag(value).over(across)).otherwise(F.col("_inner"))
    return df.withColumn(name, previous).drop(
        "_inner", "_first", "_last", "_edge", "_group")
