"""Location table and map export from the station configuration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanepulse.functions import expressions as E


def build_locations(cfg: DataFrame) -> DataFrame:
    """Station configuration -> rows of the location table."""
    name, sensor = F.col("volledige_naam"), F.col("`@unieke_id`")
    return cfg.select(
        F.concat(name, F.lit("-"), sensor).alias("locatieId"),
        name.alias("locatie"),
        sensor.cast("int").alias("id"),
        E.decimal_comma(F.col("lengtegraad_EPSG_4326")).cast("double").alias("longitude"),
        E.decimal_comma(F.col("breedtegraad_EPSG_4326")).cast("double").alias("latitude"),
    )


def filter_stations(cfg: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Stations on the allow-list."""
    return cfg.where(F.col("`@unieke_id`").isin(list(ids)))


def _feature():
    sensor = F.col("`@unieke_id`")
    return F.struct(
        F.lit("Feature").alias("type"),
        sensor.alias("id"),
        F.struct(
            F.lit("Point").alias("type"),
            F.array(
                E.decimal_comma(F.col("lengtegraad_EPSG_4326")).cast("double"),
                E.decimal_comma(F.col("breedtegraad_EPSG_4326")).cast("double"),
            ).alias("coordinates"),
        ).alias("geometry"),
        F.struct(
            F.concat(F.col("volledige_naam"), F.lit(" - "), sensor).alias("name")
        ).alias("properties"),
    )


def geojson_features(cfg: DataFrame) -> DataFrame:
    """One GeoJSON point feature per station: id, nested struct, JSON text."""
    return cfg.select(F.col("`@unieke_id`").alias("id"), _feature().alias("feature")).select(
        "id", "feature", F.to_json("feature").alias("json"))


def geojson_collection(cfg: DataFrame, ids: Sequence[str]) -> DataFrame:
    """One FeatureCollection document of the listed stations.

    The list bounds the document: one station, one feature. A map of the whole
    network is written as one feature per line instead (``geojson_features``).
    A station that is configured twice is two features.
    """
    listed = filter_stations(cfg, ids)
    features = listed.select(_feature().alias("f")).agg(
        F.sort_array(F.collect_list("f")).alias("features"))
    return features.select(
        F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value"))
