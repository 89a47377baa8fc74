"""Intake: new files become staged readings, and a bad row cannot stop what follows.

A first query takes new files at a limited rate, sorts their rows and stages what is
usable; a second, stateful one reads the staged rows as a file stream. So state never
meets a row that cannot be read, and neither query has to be stopped for one.

Rows go two ways out of one batch. Declared checks name rows that are known to be bad
(a record that is no JSON, a missing field); they go to the quarantine with the name of
the check. Whatever else makes ``prepare`` fail is found by trial: a batch that fails
again and again is written once, cut by a hash of its rows into parts of some thousand
rows; parts that fail alone are halved until what fails is one row, or equal ones, which
go to the quarantine with their error. Trials read their part only and run side by side,
and all rows that can be prepared are then prepared in one pass. Checks cost nothing
more, a row found by trial about fifteen small jobs. So ``faults`` may name, row by row,
the errors that ``prepare`` is known to raise: a batch that failed loses those rows in one
pass and is tried again, and only what fails still is cut.

Staged and quarantined batches appear by a rename, under the query and batch that made
them. A batch that runs again finds its folder and leaves it, so the files that a reader
has seen stay the same.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanepulse import storage

log = logging.getLogger(__name__)

#: Rows of a part that a failing batch is cut into, about.
PART_ROWS = 4_096
REASON, ERROR = "reason", "error"
_CODE, _PART = "_intake_code", "_intake_part"


def run_of(spark: SparkSession) -> str:
    """The id of the streaming query whose batch this is; it lives in its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def batch_folder(spark: SparkSession, batch_id: int) -> str:
    return f"run={run_of(spark)}/batch={batch_id}"


def start_bound(spark: SparkSession, checkpoint: str, at_ms: int | None = None) -> int:
    """Epoch milliseconds from which a query with this checkpoint reads: now, when it first starts.

    The bound is kept in the checkpoint, so a restart neither skips nor rereads files.
    """
    kept = f"{checkpoint.rstrip('/')}/start-ms"
    found = storage.read_text(spark, kept)
    if found is None:
        found = str(time.time_ns() // 1_000_000 if at_ms is None else at_ms)
        storage.write_text(spark, kept, found)
    return int(found)


def failed_check(checks: Mapping[str, str]) -> Column:
    """The name of the first check (a condition in SQL that is true for bad rows), else null."""
    found = F.lit(None).cast("string")
    for name, bad in reversed(checks.items()):
        found = F.when(F.coalesce(F.expr(bad), F.lit(False)), name).otherwise(found)
    return found


def _brief(e: Exception) -> str:
    return f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"[:500]


@dataclass(frozen=True)
class Intake:
    """Sorts each micro-batch into ``staged`` readings and ``quarantine`` below ``root``.

    ``prepare`` makes readings of raw rows; ``checks`` (name: condition in SQL) are of raw
    rows. ``files`` limits the files of a staged batch, for readers that need its rows in
    one micro-batch; by default Spark decides. Quarantined rows keep all their columns,
    with ``reason`` (a check's name, or ``failed``) and ``error``.

    ``late``: a time column of the readings and seconds. Readings that are older than the
    newest one of earlier batches by more go to ``late_rows`` instead, as the watermark of
    the query behind would drop them; a reading without a time is not late.

    ``faults``: a column of raw rows, the error that ``prepare`` would raise, null if none is
    known. It is asked once a batch has failed.
    """

    root: str
    prepare: Callable[[DataFrame], DataFrame]
    checks: Mapping[str, str] = field(default_factory=dict)
    retries: int = 2
    files: int | None = None
    late: tuple[str, int] | None = None
    faults: Callable[[DataFrame], Column] | None = None

    @property
    def staged(self) -> str:
        return f"{self.root.rstrip('/')}/staged"

    @property
    def quarantine(self) -> str:
        return f"{self.root.rstrip('/')}/quarantine"

    @property
    def late_rows(self) -> str:
        return f"{self.root.rstrip('/')}/late"

    def _newest(self, spark: SparkSession, batch_id: int) -> str:
        """Where the newest time up to a batch is kept, in microseconds."""
        return f"{self.root.rstrip('/')}/newest/{batch_folder(spark, batch_id)}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = batch_folder(spark, batch_id)
        if storage.exists(spark, f"{self.staged}/{name}"):
            return
        attempt = f"{self.root.rstrip('/')}/attempt/{name}"
        storage.delete(spark, attempt)
        # read once; a lost executor's part is read from its files again
        rows = batch.withColumn(REASON, failed_check(self.checks)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            usable = rows.where(F.col(REASON).isNull()).drop(REASON)
            bad = rows.where(F.col(REASON).isNotNull()).withColumn(ERROR, F.lit(None).cast("string"))
            parts = [f"{attempt}/whole"]
            error = self._tried(usable, parts[0], self.retries)
            if error is not None and self.faults is not None:
                fault = self.faults(usable)
                bad = bad.unionByName(usable.where(fault.isNotNull()).withColumns({REASON: F.lit("failed"), ERROR: fault}))
                usable = usable.where(fault.isNull())
                error = self._tried(usable, parts[0], self.retries)
            if error is not None:
                parts, failed = self._cut(usable, attempt, error)
                bad = bad.unionByName(failed)
            self._publish(spark, parts, usable, attempt, bad, batch_id)
            # the staged folder comes last: with it, the batch is done
            storage.move(spark, f"{attempt}/quarantine", f"{self.quarantine}/{name}")
            if self.late is not None:
                storage.move(spark, f"{attempt}/late", f"{self.late_rows}/{name}")
            storage.move(spark, f"{attempt}/staged", f"{self.staged}/{name}")
        finally:
            rows.unpersist()
        storage.delete(spark, attempt)

    def _tried(self, rows: DataFrame, path: str, retries: int) -> str | None:
        """Writes what ``prepare`` makes; the error, if that fails each time."""
        error = None
        for n in range(retries + 1):
            try:
                self.prepare(rows).write.mode("overwrite").parquet(path)
                return None
            except Exception as e:  # noqa: BLE001 - any failure is diverted
                error = _brief(e)
                log.warning("attempt %s failed: %s", n + 1, error)
        return error

    def _cut(self, rows: DataFrame, attempt: str, error: str) -> tuple[list[str], DataFrame]:
        """Writes what can be prepared; its folders, and the rows that cannot, with reason and error."""
        spark, columns = rows.sparkSession, [F.col(f"`{c}`") for c in rows.columns]
        # a hash leaves out nulls, so where they are counts as well
        code = F.xxhash64(*columns, *(c.isNull() for c in columns))
        number = -(-rows.count() // PART_ROWS) or 1
        coded = rows.withColumn(_CODE, code).withColumn(_PART, F.pmod(_CODE, F.lit(number)).cast("int"))
        coded.repartition(min(number, spark.sparkContext.defaultParallelism * 4), _PART) \
            .write.partitionBy(_PART).parquet(f"{attempt}/cut")
        cut = spark.read.schema(coded.schema).parquet(f"{attempt}/cut")

        def try_part(part: int) -> list[str]:
            """Folders of what can be prepared; the codes of what cannot are written with their errors."""
            own, base = cut.where(F.col(_PART) == part).coalesce(1), f"{attempt}/parts/{part}"
            if self._tried(own.select(*columns), base, 0) is None:
                return [base]
            # PART_ROWS numbers, about; equal rows share theirs
            codes = sorted(r[0] for r in own.select(_CODE).distinct().collect())
            good, failed = [], []

            def search(low: int, high: int, fails: bool) -> bool:
                """Whether some of these codes fail; ``fails``: they do, as is known from others."""
                if not fails or high - low == 1:
                    share = own.where(F.col(_CODE).between(codes[low], codes[high - 1])).select(*columns)
                    found = self._tried(share, f"{base}-{low}-{high}", 0)
                    if found is None:
                        good.append(f"{base}-{low}-{high}")
                        return False
                    if high - low == 1:
                        failed.append((codes[low], found))
                        return True
                middle = (low + high) // 2
                first = search(low, middle, False)
                return search(middle, high, not first) or first

            search(0, len(codes), True)
            spark.createDataFrame(failed, error_schema).coalesce(1).write.parquet(f"{attempt}/errors/{part}")
            return good

        error_schema = f"`{_CODE}` long, `{ERROR}` string"
        found = [r[0] for r in cut.select(_PART).distinct().collect()]
        with ThreadPoolExecutor(spark.sparkContext.defaultParallelism) as pool:
            good = [path for paths in pool.map(inheritable_thread_target(spark)(try_part), found) for path in paths]
        if not storage.exists(spark, f"{attempt}/errors"):  # each part can be prepared alone
            return good, rows.where(F.lit(False)).withColumns({REASON: F.lit("failed"), ERROR: F.lit("")})
        errors = spark.read.schema(error_schema).parquet(f"{attempt}/errors/*")
        log.warning("rows fail alone, in a batch that failed with: %s", error)
        bad = cut.join(errors, _CODE).select(*columns, F.lit("failed").alias(REASON), ERROR)
        # in one pass, so that there are no small files; a failure that only many rows share leaves the parts
        rest = cut.join(errors, _CODE, "left_anti").select(*columns)
        if self._tried(rest, f"{attempt}/whole", 0) is None:
            return [f"{attempt}/whole"], bad
        return good, bad

    def _publish(self, spark: SparkSession, parts: list[str], usable: DataFrame, attempt: str,
                 bad: DataFrame, batch_id: int) -> None:
        bad.write.parquet(f"{attempt}/quarantine")
        if self.files is None and self.late is None and len(parts) == 1 and parts[0].endswith("/whole"):
            storage.move(spark, parts[0], f"{attempt}/staged")
            return
        schema = self.prepare(usable).schema
        found = spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)
        if self.late is not None:
            found = self._split_late(spark, found, f"{attempt}/late", batch_id)
        (found if self.files is None else found.coalesce(self.files)).write.parquet(f"{attempt}/staged")

    def _split_late(self, spark: SparkSession, found: DataFrame, path: str, batch_id: int) -> DataFrame:
        """Writes the late readings; returns the others."""
        time_col, seconds = self.late
        known = storage.read_text(spark, self._newest(spark, batch_id - 1))
        us = F.unix_micros(time_col)
        newest = found.agg(F.max(us)).first()[0]
        newest = max((int(x) for x in (known, newest) if x is not None), default=None)
        storage.delete(spark, self._newest(spark, batch_id))
        if newest is not None:
            storage.write_text(spark, self._newest(spark, batch_id), str(newest))
        late = F.lit(False) if known is None else F.coalesce(us < int(known) - seconds * 1_000_000, F.lit(False))
        found.where(late).write.parquet(path)
        return found.where(~late)

    def read_staged(self, spark: SparkSession, schema: T.StructType, max_files: int | None = None) -> DataFrame:
        """The staged readings as a stream, batch after batch."""
        reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(self.staged)

    def read_late(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """All late readings."""
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(self.late_rows)

    def read_quarantine(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """All quarantined rows; ``schema`` is that of the raw rows."""
        fields = [*schema.fields, T.StructField(REASON, T.StringType()), T.StructField(ERROR, T.StringType())]
        return spark.read.schema(T.StructType(fields)).option("recursiveFileLookup", True).parquet(self.quarantine)
