"""Hard negatives against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lanepulse.llm import hard_negatives, queries


def mined(rows, n_positives=5, n_negatives=10, low=30, high=90, every=100):
    """``rows``: (id, label, vector of whole numbers)."""
    def score(a, b):
        return sum(x * y for x, y in zip(a, b))  # what is missing counts as zero

    out = []
    for i, label, v in rows:
        if i % every:
            continue
        others = sorted(((-score(v, w), j, lab) for j, lab, w in rows if j != i), key=lambda t: t[:2])
        for s, j, _ in [t for t in others if t[2] == label][:n_positives]:
            fits = [t for t in others if t[2] != label and low * -s <= 100 * -t[0] <= high * -s][:n_negatives]
            out += [(i, j, rank, t[1], -s, -t[0]) for rank, t in enumerate(fits, 1)]
    return sorted(out)


def found(df):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[c] for c in names) for r in df.collect())


def vectors(spark, rows):
    return spark.createDataFrame(rows, "id long, label long, vector array<long>").repartition(3)


def clustered(n, seed, width=12, copies=0):
    pick = random.Random(seed)
    centres = [[pick.gauss(0, 40) for _ in range(width)] for _ in range(4)]
    rows = [(i, pick.randrange(4), [int(c + pick.gauss(0, 30)) for c in pick.choice(centres)]) for i in range(n)]
    return rows + [(n + k, k % 3, rows[5][2]) for k in range(copies)]


def test_registered_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = []
    for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect():
        x = r.embedding
        if r.label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        label = (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label
        rows.append((r.vec_id, label, [math.floor(256 * c) for c in x]))
    expected = mined(rows)
    assert found(queries.QUERIES["op12_hard_negatives"](spark, folder)) == expected and len(expected) > 100


@pytest.mark.parametrize("sample", [4, 2048])
def test_thresholds_fall_until_windows_fill(spark, monkeypatch, sample):
    """A sample that is too small costs rounds, not rows; a hot vector fills many windows with ties."""
    monkeypatch.setattr(hard_negatives, "SAMPLE", sample)
    monkeypatch.setattr(hard_negatives, "ROWS", 60)
    monkeypatch.setattr(hard_negatives, "QUERIES", 7)
    rows = clustered(300, sample, copies=150)
    assert found(hard_negatives.mine(vectors(spark, rows), every=20)) == mined(rows, every=20)


def test_odd_vectors(spark):
    rows = [(0, 1, [3, 4]), (100, 1, []), (1, 1, [5]), (2, 2, [4, 1, 9]), (3, 2, [0, 0]), (200, 3, [1, 1]),
            (-100, 2, [2, -2, 7]), (5, 1, [-3, -4]), (6, 2, [-1, -1])]
    odd = [*rows, (None, 1, [1, 1]), (7, None, [1, 1]), (8, 1, None), (2, 2, [4, 1, 9]), (2, 3, [0])]
    df = vectors(spark, odd)
    assert found(hard_negatives.mine(df, low=0, high=100)) == mined(rows, low=0, high=100)
    assert hard_negatives.mine(df.filter("id > 1000")).count() == 0
    assert hard_negatives.mine(df.filter("id = 200")).count() == 0


def test_scores_beyond_doubles(spark):
    rows = [(i, i % 2, [2**29 + i * 7, i, -(2**28) + i]) for i in range(0, 60)]
    assert found(hard_negatives.mine(vectors(spark, rows), every=10, low=0, high=100)) \
        == mined(rows, every=10, low=0, high=100)


def test_usable_and_quantized(spark):
    rows = [(1, [0.5, -0.001]), (2, [float("nan")]), (3, [1.0, None]), (4, None), (5, [float("-inf")]), (6, [])]
    df = spark.createDataFrame(rows, "id long, v array<float>").filter(hard_negatives.usable(F.col("v")))
    got = {r.id: r.q for r in df.select("id", hard_negatives.quantized(df["v"]).alias("q")).collect()}
    assert got == {1: [128, -1], 6: []}


def test_index_leaves_out_covered_dimensions_and_loses_nothing():
    pick = np.random.default_rng(3)
    rows = (pick.normal(size=(500, 32)) * 50 / np.arange(1, 33)).astype(np.int64)
    queries_ = rows[:40]
    least = np.full(40, 4000.0)
    reach = (least / np.sqrt((queries_.astype(float) ** 2).sum(axis=1))).min()
    index = hard_negatives.Index(rows, reach)
    assert index.ends.min() < 32
    full = queries_ @ rows.T
    for q, (near, score) in enumerate(index.candidates(queries_, least)):
        assert set(np.flatnonzero(full[q] >= 4000)) <= set(near.tolist())
        assert (full[q, near] == score).all() and len(near) < 500
