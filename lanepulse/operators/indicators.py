"""Jam flag and speed-change flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanepulse.functions import expressions as E


def jam_indicator(
    df: DataFrame,
    avg: str = "avgSpeed3Minutes",
    occ: str = "bezettingsgraad",
    lo: int = 40,
    hi: int = 250,
) -> DataFrame:
    """Add ``trafficJamIndicator``. Averages must be integers already."""
    return df.withColumn("trafficJamIndicator", E.jam_flag(F.col(avg), F.col(occ), lo, hi))


def speed_diff(
    df: DataFrame, current: str = "speed", previous: str = "previousSpeed"
) -> DataFrame:
    """Add ``speedDiff`` = current - previous."""
    return df.withColumn("speedDiff", F.col(current) - F.col(previous))


def speed_diff_indicator(df: DataFrame, diff: str = "speedDiff", thr: int = 20) -> DataFrame:
    """Add ``speedDiffIndicator``."""
    return df.withColumn("speedDiffIndicator", E.speed_change_flag(F.col(diff), thr))


def traffic_indicators(df: DataFrame) -> DataFrame:
    """All three columns at once."""
    return (
        df.transform(jam_indicator).transform(speed_diff).transform(speed_diff_indicator)
    )
