"""Sensor-shaped inputs made from the driver's tables.

``events`` plays the readings, ``supplier`` the locations and stations, and
``lineitem`` the snapshots. The tables are sparse in time, so the queries use
12 and 48 hours where the sensors use 3 and 10 minutes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanepulse import schemas as S

HOUR = 3600
WINDOWS = {"short": 12 * HOUR, "long": 48 * HOUR, "slice_seconds": 96 * HOUR}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the shape of ``cleaning.clean_input``."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("uniqueId"),
        F.floor("value").cast("int").alias("speed"),
        F.get_json_object("props", "$.k").cast("int").alias("bezettingsgraad"),
        F.col("ts").alias("recordTimestamp"),
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``supplier`` as (id, locatie)."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("id"), F.col("s_name").alias("locatie"))


def flat_events(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """``events`` as 27-column flat events, all text.

    Class 2 carries the two sentinel speeds for two of the event types, the
    other classes carry 252 now and then.
    """
    speed = F.floor("value").cast("int").cast("string")

    def harmonic(n: int):
        if n == 2:
            return (
                F.when(F.col("event_type") == "error", "252")
                .when(F.col("event_type") == "signup", "254")
                .otherwise(speed)
            )
        return F.when(F.col("event_id") % (n + 1) == 0, "252").otherwise(speed)

    clock = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    sensor = F.col("user_id").cast("string")
    k = F.get_json_object("props", "$.k")
    columns = [
        F.concat(F.lit("H"), sensor, F.lit("L10")).alias("beschrijvende_id"),
        sensor.alias("unieke_id"),
        k.alias("lve_nr"),
        F.concat(clock, F.lit("+01:00")).alias("tijd_waarneming"),
        F.concat(clock, F.lit("+01:00")).alias("tijd_laatst_gewijzigd"),
        F.lit("1").alias("actueel_publicatie"),
        F.lit("1").alias("beschikbaar"),
        F.lit("0").alias("defect"),
        F.lit("0").alias("geldig"),
    ]
    for n in S.CLASSES:
        intensity, mean, harm = S.class_columns(n)
        columns += [
            (F.col("event_id") % (n + 3)).cast("string").alias(intensity),
            speed.alias(mean),
            harmonic(n).alias(harm),
        ]
    columns += [
        k.alias("rekendata_bezettingsgraad"),
        F.lit("100").alias("rekendata_beschikbaarheidsgraad"),
        F.lit("86").alias("rekendata_onrustigheid"),
    ]
    return table(spark, sf_dir, "events").select(*extra, *columns)


def snapshot_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as snapshot stations: an order is a station, a line a class.

    Every line is a ``meetdata`` entry, so a class may occur twice. Entries stand in
    a total order (class, ship date, part, supplier, measures); the last one of a
    class wins in the pivot. A station is one record, as long as its lines.
    """
    line = F.struct(
        "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice",
        "l_quantity", "l_tax")
    orders = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("shipped"), F.min("l_quantity").alias("occupancy"),
        F.sort_array(F.collect_list(line)).alias("lines"))

    def measured(line):
        return F.struct(
            line["l_linenumber"].cast("string").alias("@klasse_id"),
            line["l_quantity"].cast("int").cast("string").alias("verkeersintensiteit"),
            F.floor(line["l_extendedprice"] / 1000).cast("string")
            .alias("voertuigsnelheid_rekenkundig"),
            F.round(line["l_tax"] * 100).cast("int").cast("string")
            .alias("voertuigsnelheid_harmonisch"),
        )

    clock = F.date_format("shipped", "yyyy-MM-dd'T'HH:mm:ss")
    key = F.col("l_orderkey").cast("string")
    return orders.select(
        F.concat(F.lit("H@"), key).alias("@beschrijvende_id"),
        key.alias("@unieke_id"),
        F.lit("31").alias("lve_nr"),
        F.concat(clock, F.lit("+01:00")).alias("tijd_waarneming"),
        F.concat(clock, F.lit("+01:00")).alias("tijd_laatst_gewijzigd"),
        F.lit("0").alias("actueel_publicatie"),
        F.lit("1").alias("beschikbaar"),
        F.lit("0").alias("defect"),
        F.lit("0").alias("geldig"),
        F.transform("lines", measured).alias("meetdata"),
        F.struct(
            F.col("occupancy").cast("int").cast("string").alias("bezettingsgraad"),
            F.lit("100").alias("beschikbaarheidsgraad"),
            F.lit("0").alias("onrustigheid"),
        ).alias("rekendata"),
    )


def station_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``supplier`` as station configuration, decimals with a comma."""
    key = F.col("s_suppkey").cast("string")
    return table(spark, sf_dir, "supplier").select(
        key.alias("@unieke_id"),
        F.concat(F.lit("H"), key, F.lit("L10")).alias("beschrijvende_id"),
        F.col("s_name").alias("volledige_naam"),
        F.lit("B0070004").alias("Ident_8"),
        F.lit("12").alias("lve_nr"),
        F.lit("7,250").alias("Kmp_Rsys"),
        F.lit("L20").alias("Rijstrook"),
        F.lit("100200,5").alias("X_coord_EPSG_31370"),
        F.lit("200100,25").alias("Y_coord_EPSG_31370"),
        F.concat(F.col("s_nationkey").cast("string"), F.lit(",5")).alias("lengtegraad_EPSG_4326"),
        F.concat(F.lit("51,"), key, F.lit("1")).alias("breedtegraad_EPSG_4326"),
    )
