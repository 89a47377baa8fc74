"""Fingerprints against plain Python."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

import brute
from lanepulse.llm import fingerprints, queries

STARTS, STEPS, _ = fingerprints._walks()


def chained(numbers, seed=42):
    for x in numbers:
        seed = xxhash.xxh64((x % 2**64).to_bytes(8, "little"), seed=seed).intdigest()
    return seed


def fingerprint(text):
    words = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in brute.words((text or "").translate(brute.LOWER))]
    if not words:
        return ""
    hashes = {chained(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {chained(words)}
    bins = {}
    for h in hashes:
        # bins follow the order of signed numbers
        place = ((h >> 56) + 128) % 256
        bins[place] = min(bins.get(place, 2**64), h)
    out = []
    for i in range(256):
        at = i if i in bins else next(
            p for t in range(256) if (p := (STARTS[i] + t * STEPS[i]) % 256) in bins)
        out.append(bins[at] % 256)
    return bytes(out).hex()


def alike(a, b):
    if not a or not b:
        return float(a == b)
    same = sum(x == y for x, y in zip(bytes.fromhex(a), bytes.fromhex(b), strict=True)) / 256
    return max((same - 1 / 256) / (1 - 1 / 256), 0.0)


def printed(rows):
    """{(id, text): what the query returns}; ids are unique."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[:len(text) - third] + following[:third]
        a, b, c = map(fingerprint, (text, edited, following))
        out[i] = (len(text), brute.sha(edited), a, b, round(alike(a, b), 9), round(alike(a, c), 9))
    return out


def found(df):
    return {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint,
                       round(r.near_edited, 9), round(r.near_next, 9)) for r in df.collect()}


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert found(queries.QUERIES["op13_fingerprints"](spark, folder)) == printed(rows)


@pytest.mark.parametrize("at_once", [3, 256])
def test_whole_corpus(spark, monkeypatch, docs, rows, at_once):
    monkeypatch.setattr(fingerprints, "_AT_ONCE", at_once)
    assert found(fingerprints.fingerprints(docs)) == printed([r[:2] for r in rows])


def test_one_row_no_rows_null_and_extreme_ids(spark, no_docs):
    assert fingerprints.fingerprints(no_docs).count() == 0
    for ids in ([7], [None], [-2**63, 2**63 - 1, 0, None, -1]):
        rows = [(i, f"text number {i} 漢字 \U0001f600 " * 3) for i in ids]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert found(fingerprints.fingerprints(docs)) == printed(rows)


def test_odd_rows(spark, odd_docs):
    got = fingerprints.fingerprints(odd_docs.withColumns({c: F.lit(1) for c in (
        "key", "bucket", "guest", "next_text", "fingerprint", "edited")})).collect()
    texts = [r.text or "" for r in odd_docs.collect()]
    assert sorted(r.fingerprint for r in got) == sorted(map(fingerprint, texts))
    # rows of one id and text follow each other: all but one are their own next
    twice = [r for r in got if r.doc_id == 6]
    assert sorted(r.near_next for r in twice)[-1] == 1.0 and len(twice) == 2


def test_many_rows_of_one_id_are_split(spark):
    rows = [(5, "the same text again and again " * 3)] * 400 + [(i, f"another text {i}") for i in range(10, 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).cache()
    points = fingerprints._split_points(fingerprints._keyed(docs, "doc_id", "text"))
    assert len({p[2] for p in points}) < len(points)
    got = fingerprints.fingerprints(docs).collect()
    # one of the copies is last and followed by the first row of all
    assert len(got) == 410 and sum(r.near_next == 1.0 for r in got if r.doc_id == 5) == 399
    docs.unpersist()


def test_likeness_estimates_similarity(spark):
    pick = random.Random(1)
    rows, true = [], {}
    for i in range(120):
        words = [f"w{pick.randrange(10**6)}" for _ in range(pick.choice((60, 150, 400, 2000)))]
        share = pick.random()
        cut = int(len(words) * share)
        other = words[:cut] + [f"x{pick.randrange(10**6)}" for _ in range(len(words) - cut)]
        sets = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in (words, other)]
        true[i] = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        rows.append((i, " ".join(words), " ".join(other)))
    df = spark.createDataFrame(rows, "i long, a string, b string")
    near = fingerprints.likeness(fingerprints.fingerprint(F.col("a")), fingerprints.fingerprint(F.col("b")))
    errors = [r.n - true[r.i] for r in df.select("i", near.alias("n")).collect()]
    assert abs(sum(errors) / 120) < 0.02 and (sum(e * e for e in errors) / 120) ** 0.5 < 0.05
