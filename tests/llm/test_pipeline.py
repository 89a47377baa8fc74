"""The pipeline against its stages done the long way."""

import collections
import re

import brute
import corpus_pipeline
from lanepulse.llm.common import table


def _passes(text):
    n, chars, symbols, again, repeated = brute.quality(text)
    lines = sum(bool(brute.words(x)) for x in (text or "").split("\n"))
    letters = sum(c.isalpha() for c in text or "")
    return not (n < 50 or 2 * repeated > n or 10 * symbols > chars or 10 * again > 3 * lines
                or chars < 2 * n or chars > 25 * n or 2 * letters < chars
                or 2 * sum(c.isupper() for c in text) > letters)


def test_pipeline(spark, rows, tmp_path):
    item = "what is the answer to this long question of the test set that nobody has seen"
    extra = [(900, rows[20][1] + " " + item + " " + rows[21][1], "en", "s1", 1), (901, rows[22][1] + "\n" + rows[22][1], "en", "s2", 1)]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([*rows, *extra], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()

    texts = {r[0]: r[1] for r in [*rows, *extra]}
    source = {r[0]: r[3] for r in [*rows, *extra]}
    texts = {i: t for i, t in texts.items() if _passes(t)}
    texts = {i: x[2] for i, x in brute.kept_lines(texts).items()}
    texts = {i: texts[i] for i, (_, root) in brute.groups(texts).items() if root == i}
    plain = " ".join(re.findall(r"\w+", item.lower()))
    texts = {i: t for i, t in texts.items() if plain not in " ".join(re.findall(r"\w+", t.lower()))}
    sizes = collections.Counter()
    for i, t in texts.items():
        sizes[source[i]] += len(brute.words(t))
    targets, taken = brute.water_fill(sizes), collections.Counter()
    for r in found:
        assert r.text == texts[r.doc_id] and r.n_chars == len(r.text)
        assert 0 < r.taken <= 2 * len(brute.words(r.text))
        taken[r.source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)
    assert 900 not in texts and len(texts) > 20


def test_stages_keep_the_columns(spark, docs, no_docs, tmp_path):
    items = spark.createDataFrame([(1, None)], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for given in (docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            left = stage(spark, given, str(tmp_path))
            assert left.columns[:5] == given.columns, name
            assert left.count() <= given.count()
    assert table(spark, str(tmp_path), "benchmark").count() == 1


def test_rows_without_an_id_are_decided_one_by_one(spark, tmp_path):
    from conftest import prose

    item = "what is the answer to this long question of the test set that nobody has seen"
    texts = [prose(700 + k, 90) for k in range(5)]
    rows = [(1, texts[0]), (None, texts[0]), (None, texts[1]), (None, texts[1]), (None, f"{texts[2]} {item}"),
            (None, texts[3]), (5, texts[3] + " more"), (7, texts[4]), (7, f"{prose(800, 90)} {item}"), (None, ""), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s1", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    def kept(df):
        assert df.columns == docs.columns
        return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)

    assert kept(corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))) == sorted(
        [rows[k] for k in (0, 2, 4, 6, 7, 8, 9, 10)], key=str)
    assert kept(corpus_pipeline.leaks(spark, docs, str(tmp_path))) == sorted(
        [r for k, r in enumerate(rows) if k not in (4, 8)], key=str)


def test_more_columns_of_any_name_come_back(spark, odd_docs, tmp_path):
    """Columns named as the stages name their own, null and repeated ids, empty and repeated texts."""
    from pyspark.sql import functions as F

    names = ("_row", "_doc", "_text", "_key", "taken", "size", "copies", "kept_text", "n_words", "_keep", "r", "tokens")
    long = "a much longer text of the corpus that has words enough to stay in it whatever comes " * 6
    docs = odd_docs.withColumn("n_chars", F.length("text").cast("long")).select(
        "doc_id", "text", "lang", "source", "n_chars", *(F.monotonically_increasing_id().alias(c) for c in names))
    docs = docs.withColumn("text", F.when(F.col("doc_id") == 5, F.concat(F.lit(long), "text")).otherwise(F.col("text")))
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        left = stage(spark, docs, str(tmp_path))
        assert set(docs.columns) <= set(left.columns), name
        if name != "mixing":
            assert left.columns == docs.columns
        rows = left.collect()
        own = {r["_row"]: r for r in docs.collect()}
        # each row has its own values; the mix has a column of its own for one of them
        assert len({r["_row"] for r in rows}) == len(rows) <= len(own)
        assert all(r[c] == own[r["_row"]][c] for r in rows for c in ("doc_id", "_doc", "size", "tokens"))
        if name == "ngram_jaccard_join":
            # one of two equal rows stays; texts without words are nobody's copies
            assert sorted(str(r.doc_id) for r in rows) == ["5", "5", "6", "7", "8", "None", "None"]
