"""Consumers of the result stream: a second stateful query that keeps the flags itself.

The first query publishes tagged records; each consumer reads them and decides on its own
what to write. Averages are written each time, the two flags only when they differ from
what is stored. A consumer with a new checkpoint takes the stored flags from the state
table, so that a restart does not write an unchanged flag again.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lanepulse import schemas as S
from lanepulse.operators import output, state
from lanepulse.sinks import tables
from lanepulse.streaming.intake import run_of
from lanepulse.streaming.processor import BUCKETS, CHUNK, NO_SENSOR

# Shipped with the query itself, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Stands for a flag that is missing; flags are -1, 0 and 1.
NO_FLAG = 9
#: Stands for a time that is missing: such records come last in their batch.
NO_TIME = 2**63 - 1
#: Places of the variants with a flag; of others the last record of a batch is written.
_FLAGGED = [S.OUTPUT_TYPES.index(t) for t in (S.SPEED_DIFFERENTIAL, S.TRAFFIC_JAM)]
# Names of the variants by place; unknown ones are at -1.
_NAMES = np.array([*S.OUTPUT_TYPES, None], object)
# One value per bucket of sensors: an entry per sensor and variant with a flag.
_STATE = "sensor array<bigint>, variant array<int>, flag array<int>"


class FlagKeeper(StatefulProcessor):
    """Lets those records of a bucket of sensors through that conditional writes would store."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("flags", _STATE)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        # a bucket's items may come in several frames
        self._keep([np.concatenate([old, initialState[name].to_numpy(np.int64)])
                    for old, name in zip(self._kept(), ("sensor", "variant", "flag"))])

    def _kept(self) -> list[np.ndarray]:
        return [np.array(v, np.int64) for v in self.state.get() or ([],) * 3]

    def _keep(self, entries: list[np.ndarray]) -> None:
        self.state.update(tuple(v.tolist() for v in entries))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # the records of a bucket in one micro-batch; the source's rate limits bound them
        frames = list(rows)
        new = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        kept = self._kept()
        stored = len(kept[0])

        def arrived(name: str) -> np.ndarray:
            return new[name].to_numpy(np.int64)

        # what is stored of a sensor and variant stands before its records
        sensor, variant, flag = (np.concatenate([v, arrived(c)]) for v, c in zip(kept, ("sensor", "variant", "flag")))
        us, position = (np.concatenate([np.zeros(stored, np.int64), arrived(c)]) for c in ("us", "position"))
        order = np.lexsort((position, us, np.arange(len(sensor)) >= stored, variant, sensor))
        sensor, variant, flag = sensor[order], variant[order], flag[order]
        head = np.ones(len(order), bool)  # a condition on an item that is not there holds
        head[1:] = (sensor[1:] != sensor[:-1]) | (variant[1:] != variant[:-1])
        last = np.append(head[1:], True)
        changed = head.copy()
        changed[1:] |= flag[1:] != flag[:-1]
        flagged = np.isin(variant, _FLAGGED)
        written = np.where(flagged, changed, last) & (order >= stored)
        left = last & flagged
        self._keep([sensor[left], variant[left], flag[left]])
        found = new[["value", "position"]].take(order[written] - stored)
        found["outputType"] = _NAMES[variant[written]]
        for first in range(0, len(found), CHUNK):
            yield found.iloc[first:first + CHUNK]

    def close(self) -> None:
        pass


def _flag() -> Column:
    own = F.when(F.col("outputType") == S.SPEED_DIFFERENTIAL, F.col("speedDiffIndicator")) \
        .when(F.col("outputType") == S.TRAFFIC_JAM, F.col("trafficJamIndicator"))
    return F.coalesce(own, F.lit(NO_FLAG)).cast("int").alias("flag")


def _sensor() -> Column:
    # the state table has a text where there is no sensor
    return F.coalesce(F.col("uniqueId").try_cast("long"), F.lit(NO_SENSOR)).alias("sensor")


def _variant() -> Column:
    place = F.array_position(F.array(*(F.lit(t) for t in S.OUTPUT_TYPES)), F.col("outputType"))
    return F.coalesce(place - 1, F.lit(-1)).cast("int").alias("variant")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("sensor"), F.lit(buckets)).alias("bucket")


def stored_flags(items: DataFrame) -> DataFrame:
    """(sensor, variant, flag) of state items with a flag, as a consumer's initial state."""
    flags = items.where(F.col("outputType").isin(S.SPEED_DIFFERENTIAL, S.TRAFFIC_JAM))
    return flags.select(_sensor(), _variant(), _flag())


def written_records(results: DataFrame, items: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The records of a result stream that change the state table, with ``position``.

    ``items`` are the state items to go on from. Records without a known variant are left
    out. Copies of an instant follow its first record (``state.collapse_results``). Sensors
    share ``buckets`` rows of state by a hash, as in ``queries.stream_speed_profile``.
    """
    follows = (F.col("outputType") == S.SPEED_DIFFERENTIAL) & F.col("previousSpeed").eqNullSafe(F.col("currentSpeed"))
    records = results.select(
        _sensor(), _variant(), F.coalesce(F.unix_micros("originalRecordTimestamp"), F.lit(NO_TIME)).alias("us"),
        F.when(follows, 1).otherwise(0).alias("position"), _flag(),
        F.to_json(F.struct(*S.RESULT_COLUMNS), output.TIME_OPTIONS).alias("value"))
    initial = None
    if items is not None:
        initial = stored_flags(items).withColumn("bucket", _bucket(buckets)).groupBy("bucket")
    kept = records.withColumn("bucket", _bucket(buckets)).groupBy("bucket").transformWithStateInPandas(
        FlagKeeper(), outputStructType="outputType string, value string, position int", outputMode="Append",
        timeMode="None", initialState=initial)
    # unknown variants go here: a filter on results that are decoded texts would decode all of them twice
    return output.known_variants(kept).select(
        F.from_json("value", S.RESULT).alias("r"), "position").select("r.*", "position")


class StateTable:
    """Stores each batch of ``written_records`` in the state table at ``path``."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self, records: DataFrame, batch_id: int) -> None:
        spark: SparkSession = records.sparkSession
        newest = state.latest_per_key(records, S.STATE_KEYS, ["originalRecordTimestamp", "position"])
        tables.write_state(spark, self.path, output.to_state_item(newest), batch_id, run_of(spark))
