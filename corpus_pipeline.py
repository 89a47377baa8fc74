"""The corpus pipeline: quality, repeated lines, near duplicates, leaks, mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes and
rereads it before the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanepulse.llm import decontamination, jaccard_join, line_dedup, mixing, quality_rules
from lanepulse.llm.common import table, words, written


#: What a stage reads; all other columns travel through it in one.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _carried(stage: Stage) -> Stage:
    """``stage`` for tables with more columns, whatever their names.

    They come back as they were; a column that the stage adds replaces one of that name.
    """
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        more = [c for c in docs.columns if c not in COLUMNS]
        if not more:
            return stage(spark, docs, sf_dir)
        packed = F.struct(*(F.col(f"`{c}`") for c in more)).alias("other_columns")
        out = stage(spark, docs.select(*COLUMNS, packed), sf_dir)
        added = [c for c in out.columns if c not in (*COLUMNS, "other_columns")]
        own = [F.col("other_columns").getField(c).alias(c) if c in more else F.col(c)
               for c in docs.columns if c not in added]
        return out.select(*own, *added)

    return run


@_carried
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the newest policy keep."""
    return quality_rules.apply_policy(quality_rules.ledger(docs), "v2").select(docs.columns)


@_carried
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that a document with a smaller id holds; no document goes."""
    left = line_dedup.dedup_lines(docs)
    return left.withColumns({
        "text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long"),
    }).select(docs.columns)


@_carried
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest row of each group of near copies, by id (null is last) and hash of the text.

    Rows with one id, or none, are rows of their own; of exact copies under one id one stays.
    """
    kept = written(jaccard_join.first_rows(docs), "pipeline-first-rows")
    key = jaccard_join.row_key("doc_id", "text")
    joined = docs.select("*", *key).join(kept, ["_doc", "_row"])
    single = joined.filter("copies = 1").select(docs.columns)
    if kept.filter("copies > 1").isEmpty():
        return single
    alike = joined.filter("copies > 1").groupBy("_doc", "_row").agg(F.min(F.struct(*docs.columns)).alias("r"))
    return single.unionByName(alike.select("r.*"))


@_carried
def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no benchmark item has leaked, whatever leaked into others with their id."""
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    keyed = docs.withColumn("_key", key)
    return decontamination.clean(keyed, table(spark, sf_dir, "benchmark"), "_key").select(docs.columns)


@_carried
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, with ``taken``, their words times repetitions, and ``repeats``.

    ``repeats`` is 1.25, say, for a text that is taken once and another quarter of it. Rows
    are told apart by id and text; rows alike in both are taken alike.
    """
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    keyed = docs.withColumn("_key", key).withColumn("size", F.size(words(F.col("text"))).cast("long"))
    keys = ("_key", "source")
    taken = mixing.mix(keyed, "_key").filter("taken > 0").groupBy(*keys).agg(F.max("taken").alias("taken")) \
        .withColumnsRenamed({k: f"_of{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_of{k}")) for k in keys]
    return keyed.join(taken, on).select(
        *docs.columns, "taken", (F.col("taken") / F.col("size")).alias("repeats"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", leaks),
    ("mixing", mix),
]
#: Several stages cannot be put as SQL; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
