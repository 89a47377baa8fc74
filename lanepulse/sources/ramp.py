"""Synthetic speed ramp for load tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _speeds():
    # The 35 steps of the ramp.
    return F.concat(
        F.array_repeat(F.lit(120), 10),
        F.sequence(F.lit(120), F.lit(105), F.lit(-5)),
        F.sequence(F.lit(100), F.lit(50), F.lit(-10)),
        F.sequence(F.lit(40), F.lit(12), F.lit(-2)),
    )


def speed_ramp(sensors: DataFrame, start_ts: int, step: int = 1) -> DataFrame:
    """Each sensor event once per step, both class-2 speeds and time replaced.

    The steps are exploded inside the sensor's row: the product with a fixed
    array of 35 needs no join and no shuffle.
    """
    replaced = (
        "tijd_waarneming",
        "voertuigsnelheid_rekenkundig_klasse2",
        "voertuigsnelheid_harmonisch_klasse2",
    )
    kept = [c for c in sensors.columns if c not in replaced]
    stepped = sensors.select(*kept, F.posexplode(_speeds()).alias("step", "speed"))
    return stepped.select(
        *kept,
        "step",
        (F.lit(start_ts).cast("long") + F.col("step") * step).alias("tijd_waarneming"),
        F.col("speed").alias("voertuigsnelheid_rekenkundig_klasse2"),
        F.col("speed").alias("voertuigsnelheid_harmonisch_klasse2"),
    )
