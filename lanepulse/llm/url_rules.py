"""URL verdicts: given host and path rules, then association rules mined from them.

``apply_rules`` judges by a short list of curated rules, the longest that fits.
URLs judged so are the labels from which ``mine`` learns: FP-growth finds the
frequent combinations of URL tokens and verdict, and those with enough support
and confidence become rules, the minimal ones only. ``match`` looks rules up by
one token of theirs, the anchor, per part of the URL.

A URL has at most one token per part (``PARTS``), so at most 2^6 combinations, and
at most 2^6 / min_support rules in all, whatever the input: that bounds what is
broadcast. Only DataFrame functions and Spark's own FP-growth are used.

Null URLs and URLs without ``://`` have empty host and path and no tokens; no rule
fits them and they are allowed, as is any URL that no rule matches. Repeated rows
are judged alike. Where nothing is labelled, nothing is mined. New columns
replace columns of the same name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanepulse.llm.common import let, lower_ascii, written

_SHAPE = r"(?s)^.*?://([^/?#]*)([^?#]*)"
PARTS = ("top", "domain", "name", "sub", "folder", "suffix")
Rules = tuple[tuple[str, str], ...]


def host_and_path(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """``urls`` with ``host`` (A-Z lower-cased) and ``path``, empty if there is none."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    return urls.withColumns({
        "host": lower_ascii(F.regexp_extract(url, _SHAPE, 1)),
        "path": F.regexp_extract(url, _SHAPE, 2)})


def _fits(rule: str) -> Column:
    name, slash, rest = rule.partition("/")
    host = (F.col("host") == name) | F.endswith(F.col("host"), F.lit("." + name))
    return host & F.startswith(F.col("path"), F.lit(slash + rest))


def apply_rules(parsed: DataFrame, rules: Rules) -> DataFrame:
    """``parsed`` with ``rule``, the longest rule that fits, and ``label``, its verdict."""
    longest_first = sorted(rules, key=lambda r: (-len(r[1]), r[1]))

    def pick(value) -> Column:
        return reduce(lambda rest, r: F.when(_fits(r[1]), F.lit(value(r))).otherwise(rest),
                      reversed(longest_first), F.lit(None).cast("string"))

    return parsed.withColumns({"rule": pick(lambda r: r[1]), "label": pick(lambda r: r[0])})


def tokens() -> Column:
    """The URL's tokens, as an array with a place for each of ``PARTS`` (null: none)."""
    def at(labels: Column, k: int) -> Column:
        return F.get(labels, F.size(labels) - k)

    segments = F.split("path", "/", -1)
    last = F.get(segments, F.size(segments) - 1)
    folder = F.when(F.size(segments) > 2, F.get(segments, F.lit(1)))
    suffix = F.when(F.contains(last, F.lit(".")), F.substring_index(last, ".", -1))
    found = let(F.split("host", r"\."), lambda x: F.array(
        at(x, 1), at(x, 2), at(x, 3),
        F.when(F.size(x) > 3, F.array_join(F.slice(x, 1, F.size(x) - 3), "."))))
    values = (*(F.get(found, F.lit(k)) for k in range(4)), folder, suffix)
    return F.array(*(F.when(value != "", F.concat(F.lit(f"{part}:"), value))
                     for part, value in zip(PARTS, values, strict=True)))


def mine(labelled: DataFrame, min_support: float = 0.001, min_confidence: float = 0.95,
         min_count: int = 20) -> DataFrame:
    """(tokens, verdict, confidence, n): minimal rules from ``tokens`` and ``label``.

    A rule needs both the share and the number of labelled URLs.
    """
    baskets = written(labelled.select(F.array_compact(F.array_append(
        "tokens", F.concat(F.lit("verdict:"), F.col("label")))).alias("items")), "url-baskets")
    spark = labelled.sparkSession
    labels = baskets.count()
    if labels < min_count:
        return spark.createDataFrame([], "tokens array<string>, verdict string, confidence double, n bigint")
    model = FPGrowth(itemsCol="items", minSupport=max(min_support, min_count / labels)).fit(baskets)
    sets = written(model.freqItemsets.select(
        F.sort_array(F.filter("items", lambda x: ~x.startswith("verdict:"))).alias("tokens"),
        F.get(F.filter("items", lambda x: x.startswith("verdict:")), F.lit(0)).alias("verdict"),
        F.col("freq").alias("n")), "url-itemsets")
    alone = sets.filter("verdict IS NULL").select("tokens", F.col("n").alias("n_tokens"))
    rules = written(
        sets.filter("verdict IS NOT NULL AND size(tokens) > 0").join(alone, "tokens")
        .withColumn("confidence", F.col("n") / F.col("n_tokens"))
        .filter(F.col("confidence") >= min_confidence)
        .select("tokens", F.substring_index("verdict", ":", -1).alias("verdict"), "confidence", "n"),
        "url-rules")
    # a rule goes if the tokens less one already give the verdict as surely, or surer
    smaller = rules.select(
        F.explode(F.transform("tokens", lambda x: F.array_remove("tokens", x))).alias("smaller"),
        "tokens", "verdict", "confidence")
    r = rules.select(F.col("tokens").alias("smaller"), "verdict", F.col("confidence").alias("sure"))
    redundant = smaller.join(r, ["smaller", "verdict"]).filter("sure >= confidence") \
        .select("tokens", "verdict").distinct()
    return rules.join(redundant, ["tokens", "verdict"], "left_anti") \
        .select("tokens", "verdict", "confidence", "n")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` with ``mined``: the verdict of the surest rule, then the best supported.

    The index holds each rule once, under its token of the latest part.
    """
    part_of = {part: F.lit(i) for i, part in enumerate(PARTS)}
    place = F.create_map(*(x for part, i in part_of.items() for x in (F.lit(part), i)))
    anchored = rules.withColumn("anchor", F.sort_array(F.transform("tokens", lambda t: F.struct(
        F.element_at(place, F.substring_index(t, ":", 1)).alias("part"), t.alias("token"))),
        asc=False)[0])
    index = written(anchored.groupBy("anchor.part", "anchor.token").agg(F.collect_list(F.struct(
        "confidence", "n", "verdict", "tokens")).alias("found")), "url-index")
    found = []
    for i, part in enumerate(PARTS):
        entries = index.filter(F.col("part") == i).select(
            F.col("token").alias(f"_t{i}"), F.col("found").alias(f"_f{i}"))
        urls = urls.join(F.broadcast(entries), F.get("tokens", F.lit(i)) == F.col(f"_t{i}"), "left")
        found.append(F.filter(f"_f{i}", lambda r: F.forall(
            r["tokens"], lambda t: F.coalesce(F.array_contains("tokens", t), F.lit(False)))))
    none = F.array().cast(index.schema["found"].dataType)
    best = F.sort_array(F.flatten(F.array(*(F.coalesce(f, none) for f in found))), asc=False)
    return urls.withColumn("mined", F.get(best, F.lit(0))["verdict"]).drop(
        *(f"_{kind}{i}" for i in range(len(PARTS)) for kind in "tf"))


def judge(urls: DataFrame, rules: Rules, url_col: str = "url", min_support: float = 0.001,
          min_confidence: float = 0.95) -> DataFrame:
    """``urls`` with host, path, rule, mined and ``verdict`` (allow or block)."""
    parsed = apply_rules(host_and_path(urls, url_col), rules).withColumn("tokens", tokens())
    labelled = parsed.filter("label IS NOT NULL").select("tokens", "label")
    judged = match(parsed, mine(labelled, min_support, min_confidence))
    return judged.withColumn("verdict", F.coalesce("label", "mined", F.lit("allow"))).drop("tokens")
