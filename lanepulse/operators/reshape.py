"""From nested snapshot stations to flat events."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanepulse import schemas as S
from lanepulse.functions import expressions as E
from lanepulse.functions import times


def _strip(c: Column, dtype: T.DataType, marker: str) -> Column:
    """``c`` with the marker removed from all field names and text leaves."""
    if isinstance(dtype, T.StringType):
        return E.without_marker(c, marker)
    if isinstance(dtype, T.StructType):
        fields = [
            _strip(c.getField(f.name), f.dataType, marker).alias(f.name.replace(marker, ""))
            for f in dtype.fields
        ]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda e: _strip(e, dtype.elementType, marker))
    if isinstance(dtype, T.MapType):
        entries = F.transform(
            F.map_entries(c),
            lambda e: F.struct(
                _strip(e["key"], dtype.keyType, marker),
                _strip(e["value"], dtype.valueType, marker),
            ),
        )
        return F.map_from_entries(entries)
    return c


def strip_marker(df: DataFrame, marker: str = "@") -> DataFrame:
    """Remove the XML attribute marker from every key and every text value."""
    return df.select(*[
        _strip(F.col(f"`{f.name}`"), f.dataType, marker).alias(f.name.replace(marker, ""))
        for f in df.schema.fields
    ])


def pivot_classes(
    df: DataFrame,
    arr: str = "meetdata",
    classes: Iterable[int] = S.CLASSES,
    class_field: str = "klasse_id",
) -> DataFrame:
    """Array of class measurements -> three columns per vehicle class.

    A class that occurs twice keeps its last entry; a class that is missing
    gives NULLs. The pivot stays within the row, so nothing is shuffled.
    """
    classes = list(classes)

    def last_of(n: int) -> Column:
        entries = F.filter(arr, lambda m: m[class_field].cast("string") == str(n))
        return F.try_element_at(entries, F.lit(-1))

    found = {f"_class_{n}": last_of(n) for n in classes}
    columns = [
        F.col(f"_class_{n}").getField(measure).alias(f"{measure}_klasse{n}")
        for n in classes
        for measure in S.CLASS_MEASURES
    ]
    kept = [F.col(f"`{c}`") for c in df.columns]
    return df.withColumns(found).select(*kept, *columns)


def flatten_struct(df: DataFrame, col: str, sep: str = "_") -> DataFrame:
    """Replace a (nested) struct column by its leaves, names joined by ``sep``."""

    def leaves(c: Column, dtype: T.DataType, name: str) -> list[Column]:
        if not isinstance(dtype, T.StructType):
            return [c.alias(name)]
        return [
            leaf
            for f in dtype.fields
            for leaf in leaves(c.getField(f.name), f.dataType, f"{name}{sep}{f.name}")
        ]

    columns: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        columns += leaves(c, f.dataType, f.name) if f.name == col else [c]
    return df.select(*columns)


def normalize_time(
    df: DataFrame, col: str = "tijd_waarneming", mode: str = "instant"
) -> DataFrame:
    """ISO-8601 observation time -> epoch seconds as text."""
    return df.withColumn(col, times.observed_epoch(F.col(col), mode))


def to_flat_events(df: DataFrame, mode: str = "instant") -> DataFrame:
    """Snapshot stations -> one flat 27-column event per sensor."""
    return (
        df.transform(strip_marker)
        .transform(pivot_classes)
        .drop("meetdata")
        .transform(flatten_struct, "rekendata")
        .transform(normalize_time, mode=mode)
        .select(*S.FLAT_EVENT_COLUMNS)
    )


def rename_to_english(df: DataFrame) -> DataFrame:
    """Wire names -> English names (``..._klasseN`` -> ``..._cN``)."""

    def english(name: str) -> str:
        base, mark, number = name.partition("_klasse")
        return S.ENGLISH_NAMES.get(base, base) + (f"_c{number}" if mark else "")

    return df.withColumnsRenamed({c: english(c) for c in df.columns})
