"""Spelling variants against plain Python."""

import collections
import random
import re
import zlib

import pytest

import brute
from lanepulse.llm import queries, spelling


def counts(rows, slip=None, shortest=6, least=5):
    found = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(brute.LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slip and h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= shortest:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= least}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def grouped(words, ratio=5):
    near = {w: [v for v in words if abs(len(v) - len(w)) <= 1 and v != w and one_edit(w, v)] for w in words}
    forms = {}
    for w, vs in near.items():
        top = min(vs, key=lambda v: (-words[v], v), default=None)
        forms[w] = top if top is not None and words[top] >= ratio * words[w] else None
    out = {}
    for w in words:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (forms[w], root, words[w], len(near[w]), words[forms[w]] if forms[w] else None)
    return out


def by_word(df):
    found = df.collect()
    assert len({r.word for r in found}) == len(found)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found}


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = by_word(queries.QUERIES["op11_spelling_variants"](spark, folder))
    assert found == grouped(counts(rows, 199)) and any(x[0] for x in found.values())


def test_word_counts_of_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows += [(9, "Äpfel ÄPFELN apfeln's x×y÷z " * 6), (None, "letter Letter LETTER\nletter9letter" * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for slip in (None, 1, 3):
        found = {r.word: r.n for r in spelling.word_counts(docs, shortest=4, least=2, slip=slip).collect()}
        assert found == counts(rows, slip, 4, 2)
    assert spelling.variants(spelling.word_counts(no_docs)).count() == 0


@pytest.mark.parametrize("alphabet", ["ab", "abcdeé"])
def test_dense_vocabularies(spark, alphabet):
    """Runs of equal letters, words of one letter, edits at both ends, chains of forms."""
    pick = random.Random(len(alphabet))
    words = {"".join(pick.choice(alphabet) for _ in range(pick.randrange(1, 9))): 5 ** pick.randrange(1, 5)
             for _ in range(400)}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    assert by_word(spelling.variants(df)) == grouped(words)


def test_ties_and_long_words(spark):
    long = "abcdefghij" * 400
    words = {"planet": 10, "plonet": 50, "plinet": 50, "plneet": 3, "plnet": 2,
             long: 5, long[:2000] + "q" + long[2000:]: 30, long[1:]: 7, "a" * 90: 6, "a" * 91: 40, "a" * 92: 300}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    found = by_word(spelling.variants(df))
    assert found == grouped(words)
    assert found["planet"][0] == "plinet" and found["a" * 90][1] == "a" * 92


def test_runs_of_a_hundred_thousand_letters(spark):
    docs = spark.createDataFrame([(i, "x" * 100_000 + " usual words") for i in range(5)], "doc_id long, text string")
    found = by_word(spelling.variants(spelling.word_counts(docs, least=2)))
    assert found["x" * 100_000] == (None, "x" * 100_000, 5, 0, None)
