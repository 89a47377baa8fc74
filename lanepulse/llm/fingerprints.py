"""Document fingerprints: one-permutation MinHash with optimal densification, packed.

Each shingle of five words is hashed once; the top eight bits of the hash choose a bin,
and a bin keeps its smallest hash. An empty bin i takes the value of the first full bin
of its own pseudo-random walk over all bins, ``start(i) + t * step(i)``, so different
empty bins choose independently and equal sets choose alike. The low eight bits of each
bin are kept. Different shingles agree in them by chance once in 256, which the likeness
corrects. All of it is column expressions; there is no Python in tasks.

A text is lower-cased (A-Z) and split at white space; with fewer than five words all of
it is one shingle. Null and empty texts, and those without words, have an empty
fingerprint: likeness 1 to each other, 0 to all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lanepulse.llm.common import let, lower_ascii, sha256, words, written

#: Words of a shingle, bins, and bits kept of each bin.
LENGTH, BINS, BITS = 5, 256, 8
_SHIFT = 64 - 8
#: Lower bits of a hash, which order the hashes of a bin.
_ORDER = 2**_SHIFT - 1
#: Steps of the walks that are taken one by one, before what is still empty is decided at once.
_STEPS = 8
#: Text of a bucket of neighbouring ids, and the least and largest number of buckets.
BUCKET_BYTES, LEAST_BUCKETS, MOST_BUCKETS = 16_000_000, 64, 65_536
#: Split points looked through at once.
_AT_ONCE = 256


def _walks() -> tuple[list[int], list[int], list[int]]:
    """Start and odd step of each bin's walk, and the step's inverse modulo the bins."""
    starts, steps, x = [], [], 0x9E3779B97F4A7C15
    for _ in range(BINS):
        # a linear congruential generator modulo 2^64; its high bits are used
        x = (x * 6364136223846793005 + 1442695040888963407) % 2**64
        starts.append((x >> 40) % BINS)
        steps.append((x >> 50) % BINS | 1)
    return starts, steps, [pow(s, -1, BINS) for s in steps]


def _literal(values: list[int], kind: str = "") -> str:
    return f"array({', '.join(f'{v}{kind}' for v in values)})"


def shingle_hashes(text: Column, length: int = LENGTH) -> Column:
    """Hashes of the windows of ``length`` words; of all words if they are fewer; none of none."""
    def windows(h: Column) -> Column:
        return F.transform(
            F.slice(h, 1, F.greatest(F.size(h) - (length - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, length))))

    def hashes(h: Column) -> Column:
        return F.when(F.size(h) >= length, windows(h)).when(F.size(h) > 0, F.array(F.xxhash64(h))) \
            .otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words(lower_ascii(text)), lambda w: F.xxhash64(w)), hashes)


def _binned(hashes: Column) -> Column:
    """The kept bits of the smallest hash of each bin; null where it is empty."""
    # a bin's largest possible hash stands for an empty bin, so each bin has a first one
    fill = F.expr(f"transform(sequence(0L, {BINS - 1}L), b -> shiftleft(b, {_SHIFT}) | {_ORDER}L)")

    def first_of_bins(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (
            F.shiftrightunsigned(x, _SHIFT) != F.shiftrightunsigned(F.get(s, i - 1), _SHIFT)))

    firsts = let(F.sort_array(F.concat(hashes, fill)), first_of_bins)
    return F.transform(firsts, lambda x: F.when(
        x.bitwiseAND(F.lit(_ORDER)) != _ORDER, x.bitwiseAND(F.lit(2**BITS - 1)).cast("int")))


def _densified(binned: Column) -> Column:
    """``binned`` with every empty bin filled from its walk's first full bin."""
    starts, steps, inverses = _walks()
    start, inverse = F.expr(_literal(starts)), F.expr(_literal(inverses))
    stops = [F.expr(_literal([(a + t * b) % BINS for a, b in zip(starts, steps, strict=True)])) for t in range(_STEPS)]

    def nearest(v: Column, full: Column, i: Column) -> Column:
        """Of the full bins, the one that the walk of bin i meets first: its kept bits."""
        meets = F.transform(full, lambda j: ((j - F.get(start, i)) * F.get(inverse, i)).bitwiseAND(F.lit(BINS - 1))
                            * 2**BITS + F.get(v, j))
        return F.array_min(meets).bitwiseAND(F.lit(2**BITS - 1))

    def filled(v: Column) -> Column:
        walked = F.transform(v, lambda x, i: F.coalesce(x, *(F.get(v, F.get(s, i)) for s in stops)))
        full = F.filter(F.transform(v, lambda x, i: F.when(x.isNotNull(), i)), lambda j: j.isNotNull())

        def rest(w: Column) -> Column:
            return F.when(F.exists(w, lambda x: x.isNull()), let(full, lambda s: F.transform(
                w, lambda x, i: F.coalesce(x, nearest(v, s, i))))).otherwise(w)

        return let(walked, rest)

    return let(binned, filled)


def fingerprint(text: Column) -> Column:
    """The kept bits of each bin, as an array of ``BINS`` numbers from -128; empty without words."""
    def of(hashes: Column) -> Column:
        return F.when(F.size(hashes) == 0, F.array().cast("array<tinyint>")).otherwise(
            F.transform(_densified(_binned(hashes)), lambda v: (v - 2**(BITS - 1)).cast("tinyint")))

    return let(shingle_hashes(text), of)


def packed(fp: Column) -> Column:
    """A fingerprint as lowercase hex, two digits a bin."""
    digits = F.expr("array(" + ", ".join(f"'{b:02x}'" for b in range(2**BITS)) + ")")
    return F.array_join(F.transform(fp, lambda b: F.get(digits, b.cast("int") + 2**(BITS - 1))), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two texts' shingles, from their fingerprints."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda t: t)) / F.lit(float(BINS))
    chance = 1.0 / 2**BITS
    corrected = F.greatest((same - chance) / (1 - chance), F.lit(0.0))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.when(F.size(a) == F.size(b), 1.0).otherwise(0.0)) \
        .otherwise(corrected)


_KEY = "struct<none: boolean, down: bigint, hash: bigint, salt: bigint>"


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, id, text): the key orders rows by descending id, null last; rows of one id by text.

    Rows alike in both are told apart by their place in the input, so that many of them
    need not stay together; which of them comes first does not matter.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.struct(
        F.col(id_col).isNull().alias("none"), F.bitwise_not(F.coalesce(F.col(id_col).cast("long"), F.lit(0))).alias("down"),
        F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("salt")).alias("key"),
        F.col(id_col).alias("id"), text.alias("text"))


def _split_points(keyed: DataFrame) -> list:
    """The smallest key of each range of rows, ascending; at most ``MOST_BUCKETS``."""
    size = keyed.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-size // BUCKET_BYTES)))
    found = keyed.select("key.*").repartitionByRange(buckets, "none", "down", "hash", "salt") \
        .groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct("none", "down", "hash", "salt")).alias("key"))
    return sorted(tuple(r.key) for r in found.collect())


def _struct(point: tuple) -> str:
    none, *rest = point
    # the smallest long has no literal of its own
    numbers = ", ".join(f"{v}L" if v > -2**63 else f"{v + 1}L - 1L" for v in rest)
    return f"struct({str(none).lower()}, {numbers})"


def _bucket(points: list) -> Column:
    """The number of the last split point that is not above ``key``, from 0, and whether it is the key."""
    parts = [points[i:i + _AT_ONCE] for i in range(0, len(points), _AT_ONCE)]
    heads = ", ".join(_struct(p[0]) for p in parts)
    rows = ", ".join(f"array({', '.join(map(_struct, p))})" for p in parts)
    # keys are not below the first point
    return F.expr(f"""transform(array(greatest(size(filter(array({heads}), x -> x <= key)), 1)), c -> struct(
        (c - 1) * {_AT_ONCE} + size(filter(element_at(array({rows}), c), x -> x <= key)) - 1 AS bucket,
        exists(element_at(array({rows}), c), x -> x = key) AS first))[0]""")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, fingerprint, next_text, next_fingerprint) of each row and the row behind it.

    Rows are in descending order of id, null ids last, rows of one id in a fixed order of
    their texts; the first row is behind the last. Rows go to buckets of neighbouring ids by
    split points, once; the first row of a bucket is also put behind the bucket before it.
    ``docs`` must give its rows in the same order each time it is read, if rows can be alike
    in id and text.
    """
    keyed = _keyed(docs, id_col, text_col)
    points = _split_points(keyed)
    if not points:
        points = [(False, 0, 0, 0)]
    dealt = keyed.withColumn("b", _bucket(points)).select("b.bucket", "b.first", "key", "id", "text")
    guests = written(dealt.filter("first").select(
        F.pmod(F.col("bucket") - 1, F.lit(len(points))).alias("bucket"), "text"), "fingerprint-guests")
    rows = dealt.select("bucket", F.lit(False).alias("guest"), "key", "id", "text")
    rows = rows.unionByName(guests.select(
        "bucket", F.lit(True).alias("guest"), F.lit(None).cast(_KEY).alias("key"), F.lit(None).cast(docs.schema[id_col].dataType).alias("id"),
        "text"))
    rows = rows.withColumn("fingerprint", fingerprint(F.col("text")))
    order = Window.partitionBy("bucket").orderBy("guest", "key")
    return rows.withColumns({
        "next_text": F.lead("text").over(order), "next_fingerprint": F.lead("fingerprint").over(order),
    }).filter("NOT guest").select("id", "text", "fingerprint", "next_text", "next_fingerprint")


def edited(text: str = "text", following: str = "next_text") -> Column:
    """The text with its last third replaced by as many code points from the start of the next."""
    return F.expr(f"""concat(substring({text}, 1, length({text}) - length({text}) div 3),
        substring({following}, 1, int(length({text}) div 3)))""")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    rows = with_next(docs, id_col, text_col)
    rows = rows.withColumn("edited", edited()).withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    return rows.select(
        F.col("id").alias(id_col), F.length("text").cast("long").alias("n_chars"), sha256(F.col("edited")).alias("edited_sha256"),
        packed(F.col("fingerprint")).alias("fingerprint"), packed(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
