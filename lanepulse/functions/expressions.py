"""Column expressions shared by the operators. All stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lanepulse import schemas as S


def jam_flag(avg: Column, occupancy: Column, low: int = 40, high: int = 250) -> Column:
    """1 = standing traffic, 0 = flowing or empty road, -1 = unknown."""
    slow = avg.between(0, low) & (occupancy != 0)
    flowing = avg.between(low + 1, high) | (occupancy == 0)
    return F.when(slow, 1).when(flowing, 0).otherwise(-1)


def speed_change_flag(diff: Column, threshold: int = 20) -> Column:
    """1 = accelerating, -1 = slowing down, 0 = steady or unknown."""
    return F.when(diff >= threshold, 1).when(diff <= -threshold, -1).otherwise(0)


def text(c: Column) -> Column:
    """Number to text; a missing value becomes the word ``None``."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def composite_key(output_type: Column, record_timestamp: Column) -> Column:
    """``outputType_recordTimestamp``; keeps a place for a missing time."""
    return F.concat(output_type, F.lit("_"), text(record_timestamp))


def normalize_number(c: Column) -> Column:
    """Number as JSON text: integral values without a fraction."""
    return F.when(c % 1 == 0, c.cast("bigint").cast("string")).otherwise(
        c.cast("double").cast("string"))


def without_marker(c: Column, marker: str = "@") -> Column:
    return F.translate(c, marker, "")


def decimal_comma(c: Column) -> Column:
    """``51,216`` -> ``51.216`` (still text)."""
    return F.translate(c, ",", ".")


def allow_list(spec: str) -> list[str] | None:
    """Ids of a comma separated allow-list; ``None`` when it is ``*``."""
    if spec == "*":
        return None
    return spec.replace(" ", "").split(",")


def unusable_speed(harmonic: Column) -> Column:
    """True for the sentinel speeds, false (never NULL) for all else."""
    return F.coalesce(harmonic.isin(*S.UNUSABLE), F.lit(False))


def encode_payload(json_text: Column) -> Column:
    return F.base64(json_text.cast("binary"))


def decode_payload(data: Column) -> Column:
    return F.unbase64(data).cast("string")


def landed_name(path: Column, source_prefix: str, target_prefix: str, suffix: str) -> Column:
    """Name of a derived file: prefix swapped, extension replaced, with that of a compressed file.

    Only the part of the path from the source prefix on is kept.
    """
    name = F.regexp_replace(path, f"^.*{source_prefix}", "")
    stem = F.regexp_replace(name, r"\.[^./]*(\.gz)?$", "")
    return F.concat(F.lit(target_prefix), stem, F.lit(suffix))


def jam_message(flag: Column, location: Column) -> Column:
    """Text of a notification; NULL for flags that raise none."""
    return (
        F.when(flag == "1", F.format_string(S.NEW_JAM_MESSAGE, location))
        .when(flag == "0", F.format_string(S.JAM_GONE_MESSAGE, location))
    )
