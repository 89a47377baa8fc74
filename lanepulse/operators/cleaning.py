"""Filters and cleaning between the raw events and the analytics input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanepulse import schemas as S
from lanepulse.functions import expressions as E


def _allowed(spec: str, id_col: str) -> Column:
    ids = E.allow_list(spec)
    if ids is None:
        return F.lit(True)
    return F.coalesce(F.col(id_col).isin(ids), F.lit(False))


def drop_unmeasured(
    df: DataFrame, harmonic: str = "voertuigsnelheid_harmonisch_klasse2"
) -> DataFrame:
    """Drop events without a usable car speed; a missing speed is kept."""
    return df.where(~E.unusable_speed(F.col(harmonic)))


def allow_sensors(
    df: DataFrame, spec: str | DataFrame, id_col: str = "unieke_id"
) -> DataFrame:
    """Keep listed sensors: comma separated text, ``*``, or a table of ids.

    A table of ids becomes a semi join on its first column; Spark broadcasts
    it only when its measured size is below the broadcast threshold.
    """
    if isinstance(spec, DataFrame):
        ids = spec.select(spec[spec.columns[0]].alias(id_col))
        return df.join(ids, id_col, "left_semi")
    return df.where(_allowed(spec, id_col))


def matches_filter(
    df: DataFrame,
    spec: str | DataFrame,
    harmonic: str = "voertuigsnelheid_harmonisch_klasse2",
    id_col: str = "unieke_id",
) -> DataFrame:
    """Input filter: usable measurement first, then the allow-list."""
    return allow_sensors(drop_unmeasured(df, harmonic), spec, id_col)


def _blanked(classes=S.CLASSES) -> dict[str, Column]:
    return {
        c: F.when(
            ~F.coalesce(F.col(f"voertuigsnelheid_harmonisch_klasse{n}") == S.NO_VEHICLE,
                        F.lit(False)),
            F.col(c),
        )
        for n in classes
        for c in S.class_columns(n)
    }


def remove_non_measurements(df: DataFrame) -> DataFrame:
    """Blank all three columns of each class in which no vehicle passed."""
    return df.withColumns(_blanked())


def tag_disposition(
    df: DataFrame, spec: str, record_id: str = "recordId", id_col: str = "unieke_id"
) -> DataFrame:
    """One ``(recordId, result, data)`` per record.

    ``Ok`` records carry their cleaned event as JSON; ``Dropped`` ones carry
    nothing, but keep their id.
    """
    ok = ~E.unusable_speed(F.col("voertuigsnelheid_harmonisch_klasse2")) & _allowed(spec, id_col)
    payload = [c for c in df.columns if c != record_id]
    cleaned = remove_non_measurements(df.withColumn("_ok", ok))
    return cleaned.select(
        F.col(record_id).alias("recordId"),
        F.when(F.col("_ok"), "Ok").otherwise("Dropped").alias("result"),
        F.when(F.col("_ok"), F.to_json(F.struct(*payload))).alias("data"),
    )


def observe_dispositions(tagged: DataFrame, observation: Observation | str) -> DataFrame:
    """Count records and ``Ok`` ones on the way, without a pass of their own."""
    return tagged.observe(
        observation,
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("result") == "Ok").alias("ok"),
    )


def preprocess(df: DataFrame, spec: str | DataFrame) -> DataFrame:
    """The record hook ahead of the analytics: filter, then blank classes."""
    return remove_non_measurements(matches_filter(df, spec))


def parse_events(df: DataFrame, json_col: str = "value") -> DataFrame:
    """JSON records -> the 18 typed input columns.

    Fields are read as text first, since numbers may be quoted or not; what
    is no number becomes NULL.
    """
    as_text = T.StructType([T.StructField(c, T.StringType()) for c in S.INPUT_COLUMNS])
    event = F.from_json(F.col(json_col), as_text)
    others = [c for c in df.columns if c != json_col]
    return type_input(df.select(*others, event.alias("_event")).select(*others, "_event.*"))


def type_input(df: DataFrame) -> DataFrame:
    """Flat text events -> the 18 typed input columns."""

    def typed(f: T.StructField) -> Column:
        c = F.col(f.name)
        if f.name in S.INPUT_TEXT_LENGTH:
            return F.left(c, F.lit(S.INPUT_TEXT_LENGTH[f.name])).alias(f.name)
        return c.try_cast(f.dataType).alias(f.name)

    others = [c for c in df.columns if c not in S.FLAT_EVENT_COLUMNS]
    return df.select(*others, *[typed(f) for f in S.INPUT_ROW.fields])


def clean_input(df: DataFrame) -> DataFrame:
    """Typed input -> (uniqueId, speed, bezettingsgraad, recordTimestamp)."""
    return df.select(
        F.col("unieke_id").alias("uniqueId"),
        F.col("voertuigsnelheid_rekenkundig_klasse2").alias("speed"),
        F.col("rekendata_bezettingsgraad").alias("bezettingsgraad"),
        F.timestamp_seconds(F.col("tijd_waarneming").cast("bigint")).alias("recordTimestamp"),
    )
