"""Time arithmetic that gives the same answer in every session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _zoneless(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.TimestampNTZType)


def _wall_clock_seconds(c: str) -> str:
    """SQL for the whole seconds since 1970-01-01T00:00:00 of a zone-less time."""
    return (
        f"(datediff(to_date({c}), date'1970-01-01') * 86400L"
        f" + hour({c}) * 3600 + minute({c}) * 60 + second({c}))"
    )


def _wall_clock(c: str, per_second: int) -> str:
    """SQL for the time in fractions of a second, rounded down."""
    fraction = f"(date_part('SECOND', {c}) - second({c}))"
    return (
        f"({_wall_clock_seconds(c)} * {per_second}"
        f" + cast(floor({fraction} * {per_second}) as bigint))"
    )


def epoch_seconds_sql(df: DataFrame, name: str) -> str:
    """SQL for the whole epoch seconds of ``df[name]``.

    Zone-less timestamps are read as UTC from their parts: a cast would go
    through the session time zone and bend around clock changes.
    """
    c = f"`{name}`"
    return _wall_clock_seconds(c) if _zoneless(df, name) else f"unix_seconds({c})"


def epoch_micros_sql(df: DataFrame, name: str) -> str:
    """SQL for the epoch microseconds of ``df[name]``."""
    c = f"`{name}`"
    return _wall_clock(c, 1_000_000) if _zoneless(df, name) else f"unix_micros({c})"


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Whole epoch seconds of ``df[name]``."""
    return F.expr(epoch_seconds_sql(df, name))


def epoch_millis(df: DataFrame, name: str) -> Column:
    """Epoch milliseconds of ``df[name]``, rounded down."""
    c = f"`{name}`"
    return F.expr(_wall_clock(c, 1000) if _zoneless(df, name) else f"unix_millis({c})")


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Epoch microseconds of ``df[name]``."""
    return F.expr(epoch_micros_sql(df, name))


def as_utc_instant(df: DataFrame, name: str) -> Column:
    """``df[name]`` as a timestamp; a zone-less one is read as UTC."""
    return F.timestamp_micros(epoch_micros(df, name)) if _zoneless(df, name) else F.col(name)


def utc_wall_clock(micros: Column) -> Column:
    """Epoch microseconds -> zone-less UTC timestamp."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    seconds = (micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return epoch + F.make_dt_interval(secs=seconds)


def observed_epoch(c: Column, mode: str = "instant") -> Column:
    """Epoch seconds, as text, of an ISO-8601 observation time.

    ``instant`` honours the offset. ``wall_clock`` drops it and reads the
    local clock as UTC, which is what the original feed handler does on a
    UTC host.
    """
    if mode == "instant":
        parsed = F.try_to_timestamp(c)
    elif mode == "wall_clock":
        parsed = F.try_to_timestamp(F.concat(F.substring(c, 1, 19), F.lit("Z")))
    else:
        raise ValueError(f"mode must be 'instant' or 'wall_clock', not {mode!r}")
    return F.unix_seconds(parsed).cast("string")


def now_epoch_seconds(fixed: int | None = None) -> Column:
    """Current epoch seconds, or a fixed value for repeatable runs."""
    if fixed is not None:
        return F.lit(fixed).cast("long")
    return F.unix_seconds(F.current_timestamp())


def now_epoch_millis(fixed: int | None = None) -> Column:
    """Current epoch milliseconds, or a fixed value for repeatable runs."""
    if fixed is not None:
        return F.lit(fixed).cast("long")
    return F.unix_millis(F.current_timestamp())
