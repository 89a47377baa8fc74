"""Line duplicates across documents, found by hash, returned as bitmaps.

Lines become (hash, document, position) rows, written once. They are dealt by
ranges of the hash and sorted by document and position within, so the first
occurrence of a line streams by ahead of the others. What comes back is, per
document, a bitmap of its kept lines, 64 lines a word; words in which every line
stays are left out. Texts are joined with their bitmaps at the end only.

A line that makes up more than 1/1024 of all rows would fill a partition. There
are at most 1,024 such lines, so they, with their first document, are sent to
all tasks, and their other rows are decided where they lie.

A line's key is the line without white space at both ends, A-Z lower-cased. Keys
shorter than ``min_chars`` code points always stay. A key found in one document
only stays, however often. A null or empty text is one empty line. A null id
counts as the largest id; rows with one id are one document with several texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanepulse.llm.common import LAST_ID, let, lower_ascii, stripped, written

HOT_SHARE = 1024
_WORD = 64


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _row_key(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column]:
    """The document, and which of several texts under its id."""
    return (F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_doc"),
            F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_text"))


def occurrences(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(hash, document, text, position) of each line long enough."""
    per_line = docs.select(
        *_row_key(docs, id_col, text_col), F.posexplode(lines(F.col(text_col))).alias("pos", "line"))
    keyed = per_line.withColumn("line", lower_ascii(stripped(F.col("line"))))
    return keyed.filter(F.length("line") >= min_chars).select(
        F.unhex(F.md5("line")).alias("hash"), "_doc", "_text", "pos")


def repeats(found: DataFrame) -> DataFrame:
    """The occurrences outside the first document of their hash."""
    total = found.count()
    hot = F.broadcast(
        found.groupBy("hash").agg(F.count("*").alias("n"), F.min("_doc").alias("first_doc"))
        .filter(F.col("n") * HOT_SHARE > total).drop("n"))
    order = Window.partitionBy("hash").orderBy("_doc", "pos")
    streamed = (
        found.join(hot, "hash", "left_anti")
        .repartitionByRange("hash").sortWithinPartitions("hash", "_doc", "pos")
        .withColumn("first_doc", F.first("_doc").over(order)))
    return streamed.unionByName(found.join(hot, "hash")) \
        .filter(F.col("_doc") > F.col("first_doc")).select("_doc", "_text", "pos")


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = 10) -> DataFrame:
    """(_doc, _text, keep): sorted (word, bits) pairs; a set bit is a kept line.

    Documents that keep every line have no row.
    """
    found = written(occurrences(docs, id_col, text_col, min_chars), "line-occurrences")
    word = F.floor(F.col("pos") / _WORD).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col("pos"), F.lit(_WORD)))
    words = repeats(found).groupBy("_doc", "_text", word.alias("word")).agg(
        F.bitwise_not(F.bit_or(bit)).alias("bits"))
    return words.groupBy("_doc", "_text").agg(
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("keep"))


def _dense(keep: Column) -> Column:
    """All words up to the last one in ``keep``."""
    last = F.get(keep, F.size(keep) - 1)["word"]
    return F.transform(F.sequence(F.lit(0), last), lambda w: F.coalesce(
        F.get(F.filter(keep, lambda k: k["word"] == w), 0)["bits"], F.lit(-1).cast("long")))


def _kept(all_lines: Column, keep: Column) -> Column:
    def stays(dense: Column, i: Column) -> Column:
        bits = F.coalesce(F.get(dense, F.floor(i / _WORD).cast("int")), F.lit(-1).cast("long"))
        return F.getbit(bits, F.pmod(i, F.lit(_WORD)).cast("int")) == 1

    return F.when(keep.isNull(), all_lines).otherwise(let(
        _dense(keep), lambda dense: F.filter(all_lines, lambda _, i: stays(dense, i))))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 10) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped``, one row per row."""
    bitmaps = keep_bitmaps(docs, id_col, text_col, min_chars).select(
        F.col("_doc").alias("_d"), F.col("_text").alias("_t"), F.col("keep").alias("_keep"))
    keyed = docs.drop("kept_text", "n_lines", "n_dropped").select("*", *_row_key(docs, id_col, text_col))
    joined = keyed.join(
        bitmaps, (F.col("_doc") == F.col("_d")) & (F.col("_text") == F.col("_t")), "left")
    dropped = F.aggregate(
        F.coalesce(F.col("_keep"), F.array().cast("array<struct<word:int,bits:bigint>>")),
        F.lit(0).cast("long"), lambda n, k: n + (_WORD - F.bit_count(k["bits"])))
    return joined.withColumns({
        "kept_text": let(lines(F.col(text_col)), lambda x: F.array_join(_kept(x, F.col("_keep")), "\n")),
        "n_lines": F.size(lines(F.col(text_col))).cast("long"),
        "n_dropped": dropped,
    }).drop("_doc", "_text", "_d", "_t", "_keep")
