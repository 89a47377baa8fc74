"""Long repeated passages, found on a compacted de Bruijn graph of the corpus.

Edges are windows of ``length`` words; consecutive edges of a text share a node of
``length - 1`` words. A row per edge would outgrow the texts, so paths are
compacted as they are read: consecutive edges with the same minimizer (the
smallest hash among their ``SEED``-word seeds) form one path. Equal edges have
equal minimizers, so all occurrences of an edge meet under one minimizer.

Joins then decide paths from the cheapest to the dearest:

1. minimizers seen in one document only are dropped; nothing of them repeats;
2. a minimizer with one path text does not branch: the path is a repeat as a
   whole in every document but the smallest;
3. where several path texts branch off one minimizer, equal path texts are first
   merged, and all but their smallest document are decided;
4. only the smallest documents of branching paths go back to their source
   coordinates and are unfolded into single edges, which are compared.

All groups are reduced by partial aggregation (smallest and largest document)
and joined back to their rows, so no group is gathered. Paths and edges are
compared by 128 bits, minimizers by 64.

A word is removed if an edge covering it also starts in a document with a
smaller id. Null and empty texts, and texts shorter than ``length``, lose
nothing. A null id counts as the largest; rows with one id are one document with
several texts. Columns ``kept_text``, ``n_words``, ``n_removed`` are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanepulse.llm import shingles
from lanepulse.llm.common import LAST_ID, written

SEED = 16
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPANS = "array<struct<start:int,n:int>>"


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column]:
    return (F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("doc"),
            F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"))


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of the ``width`` values from each place on."""
    reach, out = 1, values.copy()
    while 2 * reach <= width:
        out[:-reach] = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    if rest:
        out[:-rest] = np.minimum(out[:-rest], out[rest:])
    return out


def _paths(words: shingles.Words, length: int, seed: int) -> tuple[np.ndarray, ...]:
    """Minimizer, first word and number of edges of each path of a slice."""
    seeds, _ = shingles.windows(words, seed)
    edge = np.flatnonzero(np.arange(len(seeds)) + length <= words.first[1:][words.text]) \
        if len(seeds) else np.zeros(0, np.int64)
    if not len(edge):
        return np.zeros(0, np.uint64), edge, edge
    least = _smallest(seeds, length - seed + 1)[edge]
    new = np.ones(len(edge), bool)
    new[1:] = (least[1:] != least[:-1]) | (np.diff(edge) != 1) | np.diff(words.text[edge]).astype(bool)
    at = np.flatnonzero(new)
    return least[at], edge[at], np.diff(np.append(at, len(edge)))


def paths(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """(minimizer, path_a, path_b, doc, text_key, start, n): compacted paths."""
    seed = max(1, min(SEED, length // 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, doc, key = (batch.column(i) for i in range(3))
            for a, b in shingles.slices(texts):
                words = shingles.split(texts.slice(a, b - a))
                least, start, n = _paths(words, length, seed)
                end = start + n - 1 + length
                row = pa.array(words.text[start] + a)
                yield pa.RecordBatch.from_arrays([
                    pa.array(least.view(np.int64)),
                    *(pa.array(shingles.spans(words, start, end, salt).view(np.int64)) for salt in (0, 1)),
                    doc.take(row), key.take(row),
                    pa.array((start - words.first[words.text[start]]).astype(np.int32)),
                    pa.array(n.astype(np.int32))], names=names)

    schema = "minimizer long, path_a long, path_b long, doc long, text_key long, start int, n int"
    names = [c.split()[0] for c in schema.split(", ")]
    return docs.select(F.col(text_col).alias("t"), *_keyed(docs, id_col, text_col)).mapInArrow(run, schema)


def edges(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """(edge_a, edge_b, doc, text_key, start): single edges of the ``wanted`` paths."""
    lists = wanted.groupBy("doc", "text_key").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    source = docs.select(F.col(text_col).alias("t"), *_keyed(docs, id_col, text_col)) \
        .join(lists, ["doc", "text_key"]).dropDuplicates(["doc", "text_key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, doc, key, lists = (batch.column(c) for c in ("t", "doc", "text_key", "spans"))
            for a, b in shingles.slices(texts):
                words = shingles.split(texts.slice(a, b - a))
                values = [shingles.windows(words, length, salt)[0].view(np.int64) for salt in (0, 1)]
                at, row = _unfolded(lists.slice(a, b - a), words)
                yield pa.RecordBatch.from_arrays([
                    *(pa.array(v[at]) for v in values),
                    doc.take(pa.array(row + a)), key.take(pa.array(row + a)),
                    pa.array((at - words.first[row]).astype(np.int32))], names=names)

    schema = "edge_a long, edge_b long, doc long, text_key long, start int"
    names = [c.split()[0] for c in schema.split(", ")]
    return source.select("t", "doc", "text_key", F.col("spans").cast(_SPANS)).mapInArrow(run, schema)


def _unfolded(lists: pa.Array, words: shingles.Words) -> tuple[np.ndarray, np.ndarray]:
    """Word number in the slice and text number of every place in the span lists."""
    flat = lists.flatten()
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    start, n = (flat.field(k).to_numpy().astype(np.int64) for k in ("start", "n"))
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    row_of = np.repeat(row, n)
    return np.repeat(words.first[row] + start, n) + inside, row_of


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = 50) -> DataFrame:
    """(doc, text_key, start, n): starts of windows that also start in a smaller document."""
    place = ("doc", "text_key", "start", "n")
    all_paths = paths(docs, id_col, text_col, length)
    # written before they are joined: large partitions of a join can be split only
    # if nothing was aggregated into them
    shared = written(
        all_paths.groupBy("minimizer").agg(
            F.min("doc").alias("least"), F.max("doc").alias("most"),
            F.min("path_a").alias("one"), F.max("path_a").alias("other"))
        .filter("least < most").select("minimizer", "least", (F.col("one") != F.col("other")).alias("branches")),
        "repeat-minimizers")
    found = written(all_paths.join(shared, "minimizer"), "repeat-paths")
    straight = found.filter(~F.col("branches") & (F.col("doc") > F.col("least"))).select(*place)

    branching = found.filter("branches").drop("minimizer", "branches", "least")
    firsts = written(branching.groupBy("path_a", "path_b").agg(F.min("doc").alias("least")), "repeat-firsts")
    merged = branching.join(firsts, ["path_a", "path_b"])
    merged_spans = merged.filter(F.col("doc") > F.col("least")).select(*place)

    open_paths = merged.filter(F.col("doc") == F.col("least")).select(*place)
    single = written(edges(docs, open_paths, id_col, text_col, length), "repeat-edges")
    seen = written(
        single.groupBy("edge_a", "edge_b").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
        .filter("least < most").drop("most"), "repeat-shared-edges")
    edge_spans = single.join(seen, ["edge_a", "edge_b"]).filter(F.col("doc") > F.col("least")) \
        .select("doc", "text_key", "start", F.lit(1).alias("n"))
    return straight.unionByName(merged_spans).unionByName(edge_spans)


def _without(text: str | None, spans: list[dict] | None, length: int) -> tuple[str, int, int]:
    words = _WORD.findall(text or "")
    if not spans:
        return " ".join(words), len(words), 0
    change = np.zeros(len(words) + 1, np.int64)
    for span in spans:
        change[span["start"]] += 1
        change[span["start"] + span["n"] - 1 + length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return " ".join(w for w, k in zip(words, keep, strict=True) if k), len(words), int((~keep).sum())


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = 50) -> DataFrame:
    """``docs`` with ``kept_text`` (words joined by blanks), ``n_words``, ``n_removed``."""
    spans = repeated_spans(docs, id_col, text_col, length) \
        .groupBy(F.col("doc").alias("_doc"), F.col("text_key").alias("_key")) \
        .agg(F.collect_list(F.struct("start", "n")).cast(_SPANS).alias("_spans"))
    base = docs.drop("kept_text", "n_words", "n_removed")
    doc, key = _keyed(base, id_col, text_col)
    joined = base.join(spans, (doc == F.col("_doc")) & (key == F.col("_key")), "left").drop("_doc", "_key")
    names = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a few thousand rows at a time: kept texts are as long as the texts
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                done = [_without(t.as_py(), s.as_py(), length) for t, s in zip(
                    part.column(text_col), part.column("_spans"), strict=True)]
                text, n, gone = zip(*done, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(text, pa.string()),
                     pa.array(n, pa.int64()), pa.array(gone, pa.int64())],
                    names=[*names, "kept_text", "n_words", "n_removed"])

    added = [T.StructField("kept_text", T.StringType()), T.StructField("n_words", T.LongType()),
             T.StructField("n_removed", T.LongType())]
    return joined.mapInArrow(run, T.StructType([*base.schema.fields, *added]))
