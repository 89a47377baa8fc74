"""Hard negatives by threshold joins with suffix-norm bounds (after L2AP).

A window of a query row asks for the best rows of a kind (same label, other label)
with scores between two bounds. Rows meet queries in cells of bounded size: a block of
rows, a block of queries. In a cell, an inverted index lists for each dimension the rows
that need it: the last dimensions of a row are left out once the norm of what they hold,
times the norm of a query, cannot reach the threshold. Partial scores are summed list by
list, rows are pruned by the norms of what is left out, and only the rest is scored in
full. Thresholds start where a bounded sample of rows suggests that a window fills; a
window that did not fill comes again with a lower one, the last being its lower bound,
so results are exact whatever the sample says. A cell returns no more rows of a window
than the window asks for, which is all that can count.

Rows with a null id, label or vector, or with a null or non-finite component, take no
part. Of rows with one id, the smallest (label, then vector) takes part. Vectors of
different lengths count as zero beyond their end. Scores must fit in 64 bits. Equal
scores are ordered by id. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lanepulse.llm.common import importable, written

#: Rows and queries that meet in one cell, at most (by hash, so about).
ROWS, QUERIES = 65_536, 2_048
#: Cells that share the rows at least, for work on several executors.
BLOCKS = 16
#: Rows whose scores suggest the first thresholds.
SAMPLE = 2_048
#: A first threshold is taken to hold so many times what a window wants.
AMPLE = 3
#: Dimensions summed at once.
_DIMS = 8
#: Each further round takes a threshold that holds so many times more of the sample.
_LOWER = 8
#: Partial scores held at once in a task.
_PARTIAL = 4_000_000
_LEAST, _MOST = -(2**63), 2**63 - 1
#: Sums below this are exact in doubles.
_EXACT = 2**53

_WINDOWS = T.ArrayType(T.StructType([
    T.StructField("window", T.LongType()), T.StructField("lower", T.LongType()),
    T.StructField("upper", T.LongType()), T.StructField("threshold", T.LongType())]))


def quantized(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    """Whether the vector has finite components only."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~odd


def _matrix(lists: pa.ChunkedArray | pa.Array, width: int | None = None) -> np.ndarray:
    """Lists of numbers as rows, with zeros where a list has ended."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0) if lists.num_chunks else pa.array([], lists.type)
    first = lists.offsets.to_numpy()
    size = np.diff(first)
    width = max(int(size.max(initial=0)), width or 0)
    out = np.zeros((len(lists), width), np.int64)
    values = lists.values.to_numpy(zero_copy_only=False)[first[0]:first[-1]] if len(lists) else []
    out[np.arange(width) < size[:, None]] = values
    return out


def _summable(*parts: np.ndarray) -> list[np.ndarray]:
    """As doubles where products and sums of whole numbers stay exact in them."""
    largest = math.prod(int(np.abs(p).max(initial=0)) for p in parts)
    if largest * max(parts[0].shape[1], 1) < _EXACT:
        return [p.astype(np.float64) for p in parts]
    return list(parts)


def _suffix_norms(x: np.ndarray) -> np.ndarray:
    """Norm of each row from each dimension on; one column more, of zeros."""
    squares = np.zeros((x.shape[0], x.shape[1] + 1))
    squares[:, :-1] = np.cumsum(x[:, ::-1].astype(np.float64) ** 2, axis=1)[:, ::-1]
    return np.sqrt(squares)


class Index:
    """Inverted lists over a block of rows, for queries whose threshold is at least
    ``reach`` times their norm.

    ``ends`` has the dimensions each row lists; rows stand in descending order of it, so
    a dimension's list is a range of rows.
    """

    def __init__(self, rows: np.ndarray, reach: float):
        norms = _suffix_norms(rows)
        steps = np.append(np.arange(0, rows.shape[1], _DIMS), rows.shape[1])
        # the first step from which on what is left cannot reach the threshold
        covered = norms[:, steps] < reach
        covered[:, -1] = True
        step = covered.argmax(axis=1)
        self.order = np.argsort(-step, kind="stable")
        self.rows, self.steps, step = rows[self.order], steps, step[self.order]
        self.lists = [int(np.count_nonzero(step > s)) for s in range(len(steps) - 1)]
        self.ends = steps[step]
        self.left = norms[self.order, self.ends]

    def candidates(self, queries: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query: rows that may reach its least threshold, and their scores."""
        (rows, queries), norms = _summable(self.rows, queries), _suffix_norms(queries)
        at_once = max(1, _PARTIAL // max(len(rows), 1))
        for first in range(0, len(queries), at_once):
            some = queries[first:first + at_once]
            partial = np.zeros((len(some), len(rows)), rows.dtype)
            for s, n in enumerate(self.lists):
                if n:
                    a, b = self.steps[s], self.steps[s + 1]
                    partial[:, :n] += some[:, a:b] @ rows[:n, a:b].T
            for i, q in enumerate(range(first, first + len(some))):
                # bounds are in doubles; one more for their rounding
                bound = partial[i] + self.left * norms[q, self.ends] * (1 + 1e-9) + 1
                near = np.flatnonzero(bound >= least[q])
                score, ends = partial[i, near], self.ends[near]
                for end in np.unique(ends[ends < rows.shape[1]]).tolist():
                    at = ends == end
                    score[at] += rows[near[at], end:] @ queries[q, end:]
                yield self.order[near], score.astype(np.int64)


def best(score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` largest scores, equal ones by id."""
    if len(score) > 4 * most:
        some = np.flatnonzero(score >= -np.partition(-score, most - 1)[most - 1])
        return some[np.lexsort((ids[some], -score[some]))[:most]]
    return np.lexsort((ids, -score))[:most]


def _met(rows: pa.Table, queries: pa.Table, want: int, same: bool) -> pa.Table:
    """The rows of a cell that each window of its queries takes."""
    out = {"id": [], "window": [], "other": [], "score": []}
    if rows.num_rows and queries.num_rows:
        x, q = _matrix(rows.column("vector")), _matrix(queries.column("vector"))
        width = max(x.shape[1], q.shape[1])
        x, q = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, q))
        ids, labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
        windows = queries.column("windows").to_pylist()
        least = np.array([min(w["threshold"] for w in ws) for ws in windows], np.float64)
        norm = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
        reach = float((least / np.maximum(norm, 1e-9)).min()) * (1 - 1e-9)
        found = Index(x, reach).candidates(q, least)
        for own, label, ws, (near, score) in zip(
                queries.column("id").to_pylist(), queries.column("label").to_pylist(), windows, found, strict=True):
            fits = ((labels[near] == label) == same) & (ids[near] != own)
            near, score = near[fits], score[fits]
            for w in ws:
                inside = np.flatnonzero((score >= w["threshold"]) & (score <= w["upper"]))
                taken = inside[best(score[inside], ids[near[inside]], want)]
                out["id"].append(np.full(len(taken), own))
                out["window"].append(np.full(len(taken), w["window"]))
                out["other"].append(ids[near[taken]])
                out["score"].append(score[taken])
    return pa.table({k: pa.array(np.concatenate(v) if v else [], pa.int64()) for k, v in out.items()})


def _round(rows: DataFrame, queries: DataFrame, blocks: int, query_blocks: int, want: int, same: bool) -> DataFrame:
    """(id, window, other, score, rank): what the windows of ``queries`` find at their thresholds."""
    row_cells = rows.select(
        F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("a"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("b"), "id", "label", "vector")
    query_cells = queries.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("a"),
        F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(query_blocks)).cast("int").alias("b"), "id", "label", "vector", "windows")

    def met(left: pa.Table, right: pa.Table) -> pa.Table:
        return _met(left, right, want, same)

    found = row_cells.groupBy("a", "b").cogroup(query_cells.groupBy("a", "b")).applyInArrow(
        met, "id long, window long, other long, score long")
    order = Window.partitionBy("id", "window").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= want)


def _thresholds(queries: DataFrame, sample: list, wants: float, same: bool) -> DataFrame:
    """``queries`` with the threshold of each window at the score that ``wants`` rows of the
    sample reach, not above the window's upper bound; its lower bound where they are too few."""
    spark = queries.sparkSession
    ids, labels = (np.array([r[k] for r in sample], np.int64) for k in (0, 1))
    vectors = _matrix(pa.array([r[2] for r in sample], pa.list_(pa.int64())))
    known = spark.sparkContext.broadcast((ids, labels, vectors))
    k = max(1, math.ceil(wants))
    kind = "array<struct<window:bigint,lower:bigint,upper:bigint,threshold:bigint>>"

    def run(batches):
        ids, labels, vectors = known.value
        for batch in batches:
            q = _matrix(batch.column("vector"), vectors.shape[1])
            x = np.pad(vectors, ((0, 0), (0, q.shape[1] - vectors.shape[1])))
            xs, qs = _summable(x, q)
            scores = (qs @ xs.T).astype(np.int64)
            out = []
            for i, (own, label, ws) in enumerate(zip(*(
                    batch.column(c).to_pylist() for c in ("id", "label", "windows")), strict=True)):
                score = np.sort(scores[i][((labels == label) == same) & (ids != own)])
                new = []
                for w in ws:
                    at = int(np.searchsorted(score, w["upper"], "right")) - k
                    new.append(w | {"threshold": max(w["lower"], int(score[at])) if at >= 0 else w["lower"]})
                out.append(new)
            columns = [batch.column(c) for c in ("id", "label", "vector")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(out, batch.schema.field("windows").type)], names=["id", "label", "vector", "windows"])

    return queries.select("id", "label", "vector", "windows").mapInArrow(
        run, f"id long, label long, vector array<long>, windows {kind}")


def fill_windows(rows: DataFrame, queries: DataFrame, want: int, same: bool) -> DataFrame:
    """(id, window, other, score, rank): the best ``want`` rows of each window.

    ``rows``: (id, label, vector); ``queries``: the same and windows (window, lower, upper,
    threshold), the threshold being ignored. ``same`` takes rows of the query's label,
    else of all others. Never the row itself.
    """
    n, n_queries = rows.count(), queries.count()
    blocks, query_blocks = max(BLOCKS, -(-n // ROWS)), max(1, -(-n_queries // QUERIES))
    sample = rows.orderBy(F.xxhash64(F.lit(2), "id"), "id").limit(SAMPLE).collect()
    wants = AMPLE * want * min(1.0, len(sample) / max(n, 1))
    done, left = None, queries
    while True:
        asked = written(_thresholds(left, sample, wants, same), "windows-asked")
        found = written(_round(rows, asked, blocks, query_blocks, want, same), "windows-found")
        done = found if done is None else done.unionByName(found)
        # a window comes again if it did not fill and had not reached its lower bound
        full = found.groupBy("id", "window").agg(F.count("*").alias("n")).filter(F.col("n") >= want)
        open_ = asked.select("id", F.explode("windows").alias("w")).select("id", "w.*") \
            .filter("threshold > lower").join(full, ["id", "window"], "left_anti")
        again = written(open_.groupBy("id").agg(F.collect_list(
            F.struct("window", "lower", "upper", "threshold")).alias("windows")), "windows-open")
        if again.isEmpty():
            return done
        done = written(done.join(again.select("id", F.explode("windows.window").alias("window")),
                                 ["id", "window"], "left_anti"), "windows-done")
        left = queries.drop("windows").join(again, "id")
        wants *= _LOWER
        if wants > 2 * SAMPLE:  # the lower bounds are what is left
            wants = math.inf if not sample else len(sample) + 1


def mine(vectors: DataFrame, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
         every: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors``: (id, label, vector) of whole numbers. Anchors have an id divisible by
    ``every``; positives are the best rows of their label; negatives of another label score
    from ``low`` to ``high`` percent of the positive. No rows for an anchor without positives
    or a positive without negatives (always so if its score is below zero).
    """
    importable(vectors.sparkSession)
    alone = vectors.filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL") \
        .groupBy("id").agg(F.min(F.struct(F.col("label").cast("long").alias("label"), "vector")).alias("r"))
    rows = written(alone.select("id", "r.label", "r.vector"), "vectors")
    anchors = rows.filter(F.col("id") % every == 0)

    def window(key, lower, upper):
        return F.struct(key.alias("window"), lower.alias("lower"), upper.alias("upper"), lower.alias("threshold"))

    whole = window(F.lit(0).cast("long"), F.lit(_LEAST), F.lit(_MOST))
    positives = fill_windows(rows, anchors.withColumn("windows", F.array(whole)), n_positives, same=True)
    positives = written(positives.select(
        "id", F.col("other").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    scaled = positives.withColumns({
        "lower": F.ceil(F.lit(low) * F.col("positive_score").cast("decimal(38,0)") / 100).cast("long"),
        "upper": F.floor(F.lit(high) * F.col("positive_score").cast("decimal(38,0)") / 100).cast("long"),
    }).filter("lower <= upper")
    asked = scaled.groupBy("id").agg(
        F.collect_list(window(F.col("positive_id"), F.col("lower"), F.col("upper"))).alias("windows"))
    negatives = fill_windows(rows, anchors.join(asked, "id"), n_negatives, same=False)
    return negatives.withColumnRenamed("window", "positive_id").join(positives, ["id", "positive_id"]).select(
        F.col("id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
