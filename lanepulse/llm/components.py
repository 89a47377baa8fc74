"""Connected components of links, by alternating stars (large and small)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanepulse.llm.common import written


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """``pairs`` (u, v): each v is linked to the smallest of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = pairs.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")) \
            .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b): each node of ``links`` (a, b) and the smallest node it reaches, if smaller."""
    links = written(links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while (now := _state(links)) != before:
        before = now
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _star(both, large=True)
        small = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        links = written(_star(small, large=False), "links", links)
    return links
