"""The tagged result stream and the records derived from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanepulse import schemas as S
from lanepulse.functions import expressions as E
from lanepulse.functions import times
from lanepulse.operators import slices

# Source columns each variant fills; all others stay NULL.
_COMMON = ("uniqueId", "currentSpeed", "recordTimestamp", "location", "originalRecordTimestamp")
VARIANT_COLUMNS = {
    S.SPEED_DIFFERENTIAL: _COMMON + ("previousSpeed", "speedDiffIndicator", "bezettingsgraad"),
    S.TRAFFIC_JAM: _COMMON + ("trafficJamIndicator",),
    S.SPEED_AVG: _COMMON + ("avgSpeed3Minutes", "avgSpeed10Minutes"),
}


def enrich_location(
    df: DataFrame,
    locations: DataFrame,
    *,
    key: str = "uniqueId",
    location_key: str = "id",
    name: str = "locatie",
) -> DataFrame:
    """Left outer join with the location table; unmatched rows stay.

    No broadcast is forced: Spark broadcasts the table while its size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges,
    splitting large sensors (AQE skew join).
    """
    names = locations.select(F.col(location_key).alias(key), F.col(name).alias("location"))
    return df.join(names, key, "left")


def tag_output(df: DataFrame, output_type: str) -> DataFrame:
    """One variant of the result record: its tag, its columns, NULL elsewhere."""
    return df.selectExpr(*variant(df, output_type).values())


def variant(df: DataFrame, output_type: str) -> dict[str, str]:
    """SQL of each result column of a variant, by name."""
    filled = VARIANT_COLUMNS[output_type]
    known = {f.name: f.dataType for f in df.schema.fields}
    columns = {}
    for f in S.RESULT.fields:
        if f.name == "outputType":
            value = f"'{output_type}'"
        elif f.name in filled:
            value = f.name
        else:
            value = f"cast(NULL AS {known.get(f.name, f.dataType).simpleString()})"
        columns[f.name] = f"{value} AS {f.name}"
    return columns


def traffic_output(df: DataFrame, locations: DataFrame | None = None) -> DataFrame:
    """Readings with both flags -> three result records each.

    The location is joined once, on the single wide row, and the variants are
    exploded from it: one shuffle feeds all three, where a union would plan
    the windows three times.
    """
    if "currentSpeed" not in df.columns:
        df = df.withColumnRenamed("speed", "currentSpeed")
    if locations is not None:
        df = df.transform(enrich_location, locations)
    elif "location" not in df.columns:
        df = df.withColumn("location", F.lit(None).cast("string"))
    structs = []
    for t in S.OUTPUT_TYPES:
        own = [sql for name, sql in variant(df, t).items() if name not in _COMMON]
        structs.append(f"struct({', '.join(own)})")
    variants = F.expr(f"explode(array({', '.join(structs)}))")
    # Shared columns bypass the generator and so keep their partitioning.
    kept = [c for c in ("position", slices.SLICE) if c in df.columns]
    exploded = df.select(*_COMMON, *kept, variants.alias("_r"))
    return exploded.select(*_COMMON, *kept, "_r.*").select(*S.RESULT_COLUMNS, *kept)


def traffic_output_by_union(df: DataFrame, locations: DataFrame) -> DataFrame:
    """The same records as a plain union; the readable form, for comparison."""
    df = df.withColumnRenamed("speed", "currentSpeed").transform(enrich_location, locations)
    first, *rest = [tag_output(df, t) for t in S.OUTPUT_TYPES]
    for other in rest:
        first = first.unionByName(other)
    return first


def route(results: DataFrame) -> dict[str, DataFrame]:
    """Split results by variant; unknown variants are left out."""
    return {t: results.where(F.col("outputType") == t) for t in S.OUTPUT_TYPES}


def known_variants(results: DataFrame) -> DataFrame:
    """Results of known variants in one DataFrame."""
    return results.where(F.col("outputType").isin(*S.OUTPUT_TYPES))


def composite_key(df: DataFrame) -> DataFrame:
    """Add ``outputType_recordTimestamp``."""
    return df.withColumn(
        "outputType_recordTimestamp",
        E.composite_key(F.col("outputType"), F.col("recordTimestamp")),
    )


def to_state_item(results: DataFrame) -> DataFrame:
    """Result records -> items of the state table (keys and time as text)."""
    keyed = (
        results.transform(composite_key)
        .withColumns({
            "uniqueId": E.text(F.col("uniqueId")),
            "recordTimestamp": E.text(F.col("recordTimestamp")),
        })
        .withColumnRenamed("location", "loc")
    )
    return keyed.select(*S.STATE.fieldNames())


def dashboard_rows(results: DataFrame) -> DataFrame:
    """Result records plus their composite key."""
    return results.transform(composite_key).select(
        *S.RESULT_COLUMNS, "outputType_recordTimestamp")


#: Wire form of times: nothing is rounded, and no reader's zone matters.
TIME_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timeZone": "UTC"}


def exact_times(results: DataFrame) -> DataFrame:
    """Result records whose reading time is an instant (zone-less ones are UTC)."""
    name = "originalRecordTimestamp"
    return results.withColumn(name, times.as_utc_instant(results, name))


def decode_results(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON text or bytes of result records -> the 12 result columns."""
    return df.select(
        F.from_json(F.col(value).cast("string"), S.RESULT).alias("_r")).select("_r.*")


def encode_results(results: DataFrame) -> DataFrame:
    """Result records -> one JSON text per record, times as UTC with microseconds."""
    exact = exact_times(results)
    return exact.select(F.to_json(F.struct(*S.RESULT_COLUMNS), TIME_OPTIONS).alias("value"))
