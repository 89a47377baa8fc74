"""What the operators share: word and line rules as columns, working tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanepulse.storage import delete, work_folder

#: White space of the word and line rules: tab to carriage return, and space.
SPACE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: An id that is null counts as the largest one.
LAST_ID = 2**63 - 1


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver found it.

    Needed where the package is neither installed nor below the working directory.
    """
    root, workers = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = [p for p in workers.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        workers["PYTHONPATH"] = os.pathsep.join([*known, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, purpose: str, *replaces: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, survives lost executors.

    Spark drops the shuffle files behind it once it is there, instead of keeping them for
    as long as the driver's memory lasts. Tables of ``replaces`` that were made here are deleted once it is there; nothing may
    read them afterwards.
    """
    spark, schema, path = df.sparkSession, df.schema, work_folder(df.sparkSession, purpose)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    for old in replaces:
        discard(old)
    out = spark.read.schema(schema).parquet(path)
    out.work_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes working tables that nothing reads any more."""
    for df in tables:
        if (path := getattr(df, "work_path", None)) is not None:
            delete(df.sparkSession, path)


#: Bits of a sketch; as 64-bit words it is a table of at most 4 MB.
SKETCH_BITS = 2**24


def likely(rows: DataFrame, among: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` may be in ``among``; the rest is dropped before it is shuffled.

    A sketch of ``SKETCH_BITS`` bits is broadcast, whatever the size of ``among``. Some rows
    that are not there remain, more the larger it is; a join must follow.
    """
    at = F.pmod(F.xxhash64(F.lit(11), F.col(col)), F.lit(SKETCH_BITS))
    bit = F.expr("shiftleft(1L, int(_at % 64))")
    words = among.select(at.alias("_at")).groupBy(F.expr("_at div 64").alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    placed = rows.withColumn("_at", at).withColumn("_word", F.expr("_at div 64"))
    return placed.join(F.broadcast(words), "_word").where(F.col("_bits").bitwiseAND(bit) != 0).select(*rows.columns)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once (lambdas would repeat it)."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Maximal runs without white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+"), "")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else unchanged."""
    return F.translate(text, UPPER, UPPER.lower())


def stripped(text: Column) -> Column:
    """White space of ``SPACE`` removed at both ends."""
    return F.trim(text, F.lit(SPACE))


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def held_out(doc_id: Column, modulus: int = 4, held: int = 2) -> Column:
    """Whether the row is kept from learning: by the CRC-32 of the id's text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == held, F.lit(False))


def tokenizer(name: str) -> str:
    """The place of a public vocabulary file, the same on all machines."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
