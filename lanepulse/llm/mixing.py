"""Mixing sources to target weights by capped water-filling.

The total to take is shared by weight. A source can give at most ``max_epochs``
times its size; what is above is shared anew among the others by their weight,
until none is above. A source's target is then met by whole repetitions of all
its documents and a fractional one of some, chosen by a seeded hash: documents
are ordered by hash in 4,096 buckets, all buckets below the line are taken, and
inside the bucket on the line documents are taken in order; the one on the line
gives as many words as are missing.

So no task sees more than a 4,096th of a source, and the words taken differ from
the target by rounding only. Source tables have a row per source and go through
aggregation, never through the driver; the driver sees two sums per round.

A null source is a source, the last one. Null and empty texts have size 0, and
nothing of them is taken. Rows with one id have one hash and are ordered by size.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanepulse.llm.common import words, written

BUCKETS = 4096


def by_rank(sources: DataFrame, source_col: str, weights: tuple[float, ...]) -> DataFrame:
    """``weight`` for each source: ``weights``, repeating, by code point, null last."""
    ranked = written(
        sources.orderBy(F.col(source_col).asc_nulls_last())
        .withColumn("_at", F.monotonically_increasing_id()), "mix-order")
    part = F.shiftright("_at", 33)
    sizes = ranked.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    # a row per partition of the sort, however many sources there are
    before = sizes.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"))
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.get(F.array(*map(F.lit, map(float, weights))), F.pmod(rank, F.lit(len(weights))).cast("int"))
    return ranked.withColumn("_part", part).join(F.broadcast(before), "_part") \
        .withColumn("weight", weight).drop("_at", "_part", "_before")


def water_fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """``sources`` (``source_size``, ``weight``) with ``target``.

    Each round fixes the sources that the level puts above their cap. Rounds end
    when none is; the level only rises, so a fixed source stays fixed.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level = 0.0
    fixed = 0
    while True:
        # of the sources at their cap: words; of the others: weight
        at_cap = F.col("weight") * F.lit(level) >= cap
        row = sources.agg(
            F.sum(F.when(at_cap, cap)).alias("capped"),
            F.sum(F.when(~at_cap, F.col("weight"))).alias("weight"),
            F.count(F.when(at_cap, 1)).alias("n")).first()
        if not row["weight"] or row["n"] == fixed and level:
            break
        fixed, level = row["n"], (total - (row["capped"] or 0.0)) / row["weight"]
    if not row["weight"]:
        level = float("inf")
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), cap))


def sized(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """(id, source, size in words), written once."""
    return written(docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"),
        F.size(words(F.col(text_col))).cast("long").alias("size")), "mix-sizes")


def _null_safe(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Left join on keys that may be null, the right side's keys dropped."""
    renamed = right.withColumnsRenamed({k: f"_r{k}" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"_r{k}"]) for k in keys]
    return left.join(renamed, on, "left").drop(*(f"_r{k}" for k in keys))


def targets(sizes: DataFrame, weights: tuple[float, ...], epochs: float, max_epochs: float) -> DataFrame:
    """(_source, source_size, weight, target)."""
    per_source = written(
        sizes.groupBy("_source").agg(F.sum("size").alias("source_size")), "mix-sources")
    weighed = written(by_rank(per_source, "_source", weights), "mix-weights")
    total = (per_source.agg(F.sum("source_size")).first()[0] or 0) * float(epochs)
    return water_fill(weighed, total, max_epochs)


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: tuple[float, ...] = (5, 2, 1), epochs: float = 1.5, max_epochs: float = 2.0,
        seed: int = 17) -> DataFrame:
    """(id, source, size, source_size, target, taken): words taken of each document."""
    sizes = sized(docs, id_col, source_col, text_col)
    goals = written(targets(sizes, weights, epochs, max_epochs), "mix-targets")
    digest = F.xxhash64(F.lit(seed), F.coalesce(F.col("_id").cast("string"), F.lit("")))
    placed = sizes.withColumn("_hash", digest).withColumn(
        "_bucket", F.pmod(F.shiftrightunsigned("_hash", 20), F.lit(BUCKETS)).cast("int"))

    # words below each bucket of a source: at most BUCKETS rows per source
    in_order = Window.partitionBy("_source").orderBy("_bucket")
    per_bucket = placed.groupBy("_source", "_bucket").agg(F.sum("size").alias("_words"))
    below = per_bucket.select(
        "_source", "_bucket", "_words", (F.sum("_words").over(in_order) - F.col("_words")).alias("_below"))
    repeats = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))) \
        .otherwise(0).cast("long")
    lines = _null_safe(below, goals, "_source").withColumn("_whole", repeats).withColumn(
        "_more", F.round(F.col("target") - F.col("_whole") * F.col("source_size")).cast("long"))
    # whole: repetitions of every document here; _need: words still needed, if the line is here
    on_line = (F.col("_below") < F.col("_more")) & (F.col("_below") + F.col("_words") > F.col("_more"))
    plan = lines.select(
        "_source", "_bucket", "source_size", "target",
        (F.col("_whole") + F.when(F.col("_below") + F.col("_words") <= F.col("_more"), 1).otherwise(0))
        .alias("_times"),
        F.when(on_line, F.col("_more") - F.col("_below")).alias("_need"))

    marked = _null_safe(placed, plan, "_source", "_bucket")
    whole = F.col("_times") * F.col("size")
    result = ("_id", "_source", "size", "source_size", "target")
    easy = marked.filter(F.col("_need").isNull()).select(*result, whole.alias("taken"))
    by_hash = Window.partitionBy("_source").orderBy("_hash", "_id", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(by_hash), F.lit(0))
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("_need") - before))
    hard = marked.filter(F.col("_need").isNotNull()).select(*result, (whole + part).alias("taken"))
    return easy.unionByName(hard).withColumnsRenamed({"_id": id_col, "_source": source_col})


