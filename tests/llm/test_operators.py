"""Each operator against the long way, and on odd and empty tables."""

import collections
import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from lanepulse.llm import (
    decontamination, jaccard_join, language_id, line_dedup, mixing, quality_rules,
    substring_dedup, token_counts, toxicity, url_rules,
)
from lanepulse.llm.common import held_out, tokenizer
from lanepulse.llm.components import components


@pytest.fixture(scope="module")
def texts(rows):
    return {r[0]: r[1] for r in rows}


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- quality rules ----------------------------------------------------------

def test_quality_measurements(docs, texts):
    found = by_id(quality_rules.ledger(docs))
    for i, text in texts.items():
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.quality(text)
        base = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert base == bool(r.failures & quality_rules.mask(quality_rules.BASE))


def test_quality_policies_and_ablation(docs, no_docs, odd_docs):
    entries = quality_rules.ledger(docs)
    kept = quality_rules.apply_policy(entries, "v2").count()
    table = {(r.policy, r.left_out): r for r in quality_rules.ablation(entries).collect()}
    assert table["v2", None].kept == kept and table["v2", None].gain == 0
    without = tuple(x for x in quality_rules.POLICIES["v1"] if x != "too_few_words")
    trial = quality_rules.apply_policy(entries, "t", policies={"t": without}).count()
    assert table["v1", "too_few_words"].kept == trial
    assert table["v1", "too_few_words"].gain == trial - table["v1", None].kept
    assert quality_rules.ledger(no_docs).count() == 0
    assert quality_rules.ledger(odd_docs).count() == 8


# --- line dedup -------------------------------------------------------------

def test_line_dedup(docs, texts, no_docs, odd_docs):
    found = by_id(line_dedup.dedup_lines(docs))
    expected = brute.kept_lines(texts)
    assert {i: (r.n_lines, r.n_dropped, r.kept_text) for i, r in found.items()} == expected
    assert sum(x[1] for x in expected.values()) > 50
    assert line_dedup.dedup_lines(no_docs).count() == 0
    assert line_dedup.dedup_lines(odd_docs).count() == 8


def test_line_bitmaps_of_long_documents(spark):
    lines = [f"line number {k} of the text" for k in range(1000)]
    some = [x for k, x in enumerate(lines) if k % 3]
    docs = spark.createDataFrame(
        [(1, "\n".join(some)), (2, "\n".join(lines)), (3, None), (None, lines[1])], "doc_id long, text string")
    maps = line_dedup.keep_bitmaps(docs).collect()
    assert sorted(len(r["keep"]) for r in maps) == [1, 16]
    found = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert found[2].kept_text.split("\n") == lines[::3] and found[1].n_dropped == 0
    assert (found[3].n_lines, found[3].kept_text) == (1, "") and found[None].n_dropped == 1


def test_hot_lines_are_decided_apart(spark):
    hot = "a line that all documents hold"
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(
        F.lit(hot + "\n"), F.lit("number "), F.col("id").cast("string"), F.lit(" alone here")).alias("text"))
    found = line_dedup.dedup_lines(docs)
    assert found.agg(F.sum("n_dropped")).first()[0] == 2999


# --- similarity join --------------------------------------------------------

def test_jaccard_join(docs, texts, no_docs, odd_docs):
    found = by_id(jaccard_join.similar(docs))
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == brute.groups(texts)
    assert jaccard_join.similar(no_docs).count() == 0
    odd = jaccard_join.similar(odd_docs).collect()
    assert len(odd) == 8 and sorted(r.component_id for r in odd if r.doc_id == 6) == [6, 6]


@pytest.mark.parametrize("repeated", [9, None])
def test_texts_of_one_id_are_copies_of_different_documents(spark, repeated):
    from conftest import prose

    one, two, three = (prose(k, 120) for k in (901, 902, 903))
    docs = spark.createDataFrame(
        [(1, one), (2, two), (repeated, one), (repeated, two), (3, two + " more"), (4, three),
         (repeated, three + " more")], "doc_id long, text string").repartition(3)
    found = jaccard_join.similar(docs).collect()
    assert len(found) == 7 and {r.component_id for r in found} == {1}


@pytest.mark.parametrize("most", [0, 6, 12])
def test_boundary_does_not_change_links(spark, monkeypatch, most):
    import random

    pick = random.Random(3)
    base = [f"v{k}" for k in range(22)]
    texts = {i: " ".join(w if pick.random() > 0.04 else f"z{pick.randrange(3)}"
                         for w in base[:pick.randrange(5, 22)]) for i in range(120)}
    monkeypatch.setattr(jaccard_join, "boundary", lambda *_: most)
    monkeypatch.setattr(jaccard_join, "CHUNK", 40)  # families in many chunks and tables
    monkeypatch.setattr(jaccard_join, "MEETING", 90)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    found = by_id(jaccard_join.similar(docs))
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == brute.groups(texts)


def test_components(spark):
    links = spark.createDataFrame([(9, 8), (8, 7), (7, 3), (5, 5), (11, 12), (12, 10), (3, 9)], "a long, b long")
    assert {tuple(r) for r in components(links).collect()} == {(9, 3), (8, 3), (7, 3), (11, 10), (12, 10)}


# --- substring dedup --------------------------------------------------------

def test_substring_dedup(docs, texts, no_docs, odd_docs):
    found = by_id(substring_dedup.remove_repeats(docs))
    expected = brute.without_repeats(texts)
    assert {i: (r.n_words, r.n_removed, r.kept_text) for i, r in found.items()} == expected
    assert sum(x[1] for x in expected.values()) > 500
    assert substring_dedup.remove_repeats(no_docs).count() == 0
    assert substring_dedup.remove_repeats(odd_docs).count() == 8


def test_substring_dedup_of_short_windows(docs, texts):
    found = by_id(substring_dedup.remove_repeats(docs, length=7))
    assert {i: (r.n_words, r.n_removed, r.kept_text) for i, r in found.items()} == \
        brute.without_repeats(texts, 7)


# --- token counts -----------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(tokenizer("word_bpe_49k.json"))


def test_token_counts(spark, docs, texts, no_docs, odd_docs, library):
    extra = {900: "a<|endoftext|>b <|startoftext|>", 901: "Don't, it's 12.5% ... ok?!", 902: "ΟΔΟΣ Straße İ"}
    more = spark.createDataFrame([(i, t) for i, t in extra.items()], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(more)
    path = tokenizer("word_bpe_49k.json")
    found = by_id(token_counts.count_tokens(both, path, prefixes=True).withColumns({
        "cut": token_counts.cut_at(30), "before": token_counts.tokens_before(60)}))

    def count(text):
        return len(library.encode(text or "", add_special_tokens=False).ids)

    for i, text in {**texts, **extra}.items():
        r = found[i]
        assert r.n_tokens == count(text)
        for end, n in list(zip(r.prefix_chars, r.prefix_tokens, strict=True))[:40]:
            assert count(text[:end]) == n
        assert count((text or "")[:r.cut]) <= 30
        assert r.before == max([n for e, n in zip(r.prefix_chars, r.prefix_tokens, strict=True) if e <= 60],
                               default=0)
    assert token_counts.count_tokens(no_docs, path).count() == 0
    assert token_counts.count_tokens(odd_docs, path).count() == 8


def test_counts_at_every_prefix(spark, library):
    texts = [
        "Hello wörld, it's 12.5%", "漢字かな交じり文。" * 30, "a\tb\u3000c d" * 9, "x7F" * 40, "antidisestablishmentarianism" * 5,
        "=-~<>" * 25, "!!<|endoftext|>ab<|startoftext|" + "z" * 60, "e\u0301o\u0308" * 40, "İstanbul" * 12, "''sll'tre" * 20,
        "สวัสดีครับ" * 12, "don't'" + "ve" * 40, "か\u3099" * 30, "ΟΔΟΣ" * 20, "\u1112\u1161\u11ab" * 25, "", None,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = tokenizer("word_bpe_49k.json")
    counted = token_counts.count_tokens(docs, path, limit=7, prefixes=True, digest=True).withColumns({
        "at": token_counts.tokens_at(3), "cut": token_counts.cut_at(2)})
    found = by_id(counted)
    for i, text in enumerate(texts):
        text, r = text or "", found[i]
        expected = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(1, len(text) + 1)]
        assert r.prefix_counts == expected, text
        for cut, limit in ((r.cut_chars, 7), (r.cut, 2)):
            assert cut == max([k for k, n in enumerate(expected, 1) if n <= limit], default=0)
        assert r.at == (expected[:3] or [0])[-1]
        packed = b"".join(n.to_bytes(4, "little") for n in expected)
        assert r.prefix_sha256 == hashlib.sha256(packed).hexdigest()


def test_long_text_without_blanks_is_cut_inside(spark, library):
    text = "".join(chr(0x4E00 + 37 * k % 5000) for k in range(20_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = token_counts.count_tokens(docs, tokenizer("word_bpe_49k.json")).first()

    def count(n):
        return len(library.encode(text[:n], add_special_tokens=False).ids)

    assert r.n_tokens == count(20_000) > 2048 and r.cut_chars > 0
    assert r.cut_chars == max(n for n in range(600, 2100) if count(n) <= 2048)


# --- mixing -----------------------------------------------------------------

def test_mixing(docs, rows, no_docs, odd_docs):
    found = mixing.mix(docs).collect()
    sizes, taken = collections.Counter(), collections.Counter()
    for i, text, _, source, _ in rows:
        sizes[source] += len(brute.words(text))
    targets = brute.water_fill(sizes)
    assert len(found) == len(rows)
    for r in found:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, targets[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)
    again = {r.doc_id: r.taken for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {r.doc_id: r.taken for r in found}
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mix(odd_docs).count() == 8


# --- decontamination --------------------------------------------------------

def test_decontamination(spark, docs, rows, no_docs, odd_docs):
    item = ("first sentence of the test item comes here and goes on. "
            "second sentence asks what the answer of the item could be?")
    first, second = item.split(". ")
    items = spark.createDataFrame(
        [(1, item), (1, item), (2, None), (3, "too short"), (4, "nobody holds these words at all")],
        "item_id long, text string")
    filler = rows[10][1]
    cases = spark.createDataFrame([
        (1, f"{filler} {item} {filler}"), (2, f"{filler}\n{second.upper()} -- {filler} {first}, {filler}"),
        (3, f"{filler} {first[:30]} {filler}"), (4, None), (5, ""), (None, f"x {item}")],
        "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontamination.leaks(cases, items).collect()}
    assert set(found) == {(1, 1), (2, 1), (None, 1)}
    assert found[1, 1].n_tiles == 1 and found[1, 1].n_covered == found[1, 1].n_words
    assert found[2, 1].n_tiles == 2 and found[2, 1].n_covered == found[2, 1].n_words
    start, n = found[1, 1].spans[0]
    assert n == len(item.split()) and start == len(re.findall(r"\w+", filler))
    assert {r.doc_id for r in decontamination.clean(cases, items).collect()} == {3, 4, 5, None}
    assert decontamination.leaks(docs, items).count() == 0
    assert decontamination.leaks(no_docs, items).count() == 0
    assert decontamination.leaks(docs, items.limit(0)).count() == 0
    assert decontamination.leaks(odd_docs, items).count() == 0


def test_blocks_of_items_give_the_same_leaks(spark, monkeypatch, docs, rows):
    items = spark.createDataFrame([(i, " ".join(brute.words(rows[i][1])[3:30])) for i in range(20)],
                                  "item_id long, text string")
    one = sorted((r.doc_id, r.item_id, r.n_covered) for r in decontamination.leaks(docs, items).collect())
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 900)
    many = sorted((r.doc_id, r.item_id, r.n_covered) for r in decontamination.leaks(docs, items).collect())
    assert one == many and len(one) >= 20


def test_tiling_takes_the_longest_matches_first():
    text, item = "a b c d e f x c d e f g h".split(), "a b c d e f g h".split()
    hits = [(i, j) for i in range(len(item) - 1) for j in range(len(text) - 1) if item[i:i + 2] == text[j:j + 2]]
    found = decontamination.tiles(hits, len(item), 2)
    assert found == [(0, 0, 6), (6, 11, 2)]


# --- language ---------------------------------------------------------------

def test_language_scorer_sums_all_segmentations():
    logs = {"▁a": 0.2, "▁ab": 0.1, "a": 0.3, "b": 0.25, "ab": 0.15}
    model = {"langs": ["x"], "pieces": {p: (math.log(v),) for p, v in logs.items()}, "rare": (math.log(1e-6),)}
    scorer = language_id.Scorer(model)
    expected = 0.2 * 0.25 + 0.1 + 1e-6 * (0.3 * 0.25 + 0.15)  # the start mark alone is unknown
    assert math.isclose(scorer.words(["b", "ab"])[1][0], math.log(expected))


def test_language_id(spark, docs, no_docs, odd_docs):
    path = tokenizer("piece_bpe_32k.model")
    rows = [(i, "the house and the garden of this family are old" if i % 2 else
             "das Haus und der Garten dieser Familie sind alt", "en" if i % 2 else "de") for i in range(40)]
    train = spark.createDataFrame([*rows, (99, "irgendwas", None)], "doc_id long, text string, lang string")
    model = language_id.fit(train, path)
    assert model["langs"] == ["de", "en"]
    cases = spark.createDataFrame(
        [(1, "the old garden"), (2, "der alte Garten"), (3, None), (4, "12 -- 34"), (5, "")], "doc_id long, text string")
    found = by_id(language_id.predict(cases, model))
    assert [found[i].lang_pred for i in range(1, 6)] == ["en", "de", "und", "und", "und"]
    assert all(0 <= r.score <= 1 for r in found.values())
    assert language_id.predict(odd_docs, model).count() == 8
    assert language_id.predict(no_docs, model).count() == 0
    nothing = language_id.fit(no_docs, path)
    assert {r.lang_pred for r in language_id.predict(docs, nothing).collect()} == {"und"}


def test_language_of_odd_letters_and_long_words(spark):
    """Numerals are no letters; words of any length count whole and do not vanish."""
    path = tokenizer("piece_bpe_32k.model")
    rows = [(i, "the house and the garden of this family are old" if i % 2 else
             "das Haus und der Garten dieser Familie sind alt", "en" if i % 2 else "de") for i in range(40)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), path)
    cases = ["½ ² Ⅳ 12", "x²garden", "Garten" * 40, "garden" * 40, "\u0e01" * 3000, "Haus" * 2000]
    assert language_id.words_of(cases[1]) == ["x", "garden"]
    found = by_id(language_id.predict(spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string"), model))
    assert [found[i].lang_pred for i in (0, 2, 3, 5)] == ["und", "de", "en", "de"]
    scorer = language_id.Scorer(model)
    long = scorer.words(["garden" * 400])[0]
    assert np.isfinite(long).all() and long.max() < -700 and long[1] > long[0]


def test_language_learned_from_rows_without_words(spark):
    path = tokenizer("piece_bpe_32k.model")
    empty = spark.createDataFrame([(1, "12", "en"), (2, None, "de")], "doc_id long, text string, lang string")
    model = language_id.fit(empty, path)
    assert {r.lang_pred for r in language_id.predict(empty, model).collect()} == {"und"}


# --- toxicity ---------------------------------------------------------------

def test_clause_grammar():
    grammar = toxicity.Grammar({"fool$": 4.0, "rott": 3.0})
    plain = grammar.read("the fool came. nothing here")
    assert plain == (4.0, 1)
    assert grammar.read("you fool!")[0] > plain[0]
    assert grammar.read("she is not a fool.")[0] < plain[0] / 2
    assert grammar.read("he said fool.")[0] < plain[0]
    assert grammar.read("rotten fool; the rotting one")[1] == 2
    assert grammar.read("i will kill you") == (0.0, 0) and grammar.read("you kill")[0] > 0
    assert grammar.read(None) == grammar.read("") == grammar.read("foolish words") == (0.0, 0)


def test_targets_behind_threats_and_insults_count():
    grammar = toxicity.Grammar({"fool$": 4.0}, behind=True)
    threat, insult = toxicity.THREAT_WEIGHT * toxicity.TARGETED, 4.0 * toxicity.TARGETED
    assert grammar.read("i will kill you") == grammar.read("you i will kill") == (threat, 1)
    assert grammar.read("we will hurt and beat them") == (2 * threat, 1)
    assert grammar.read("i will kill. you") == grammar.read("i will kill it") == (0.0, 0)
    assert grammar.read("i will not kill you") == (threat * toxicity.NEGATED, 1)
    assert grammar.read("fool you") == grammar.read("you fool") == (insult, 1)
    assert grammar.read("fool you and you") == (insult, 1)
    assert grammar.read("kill the fool") == (toxicity.THREAT_WEIGHT + 4.0, 1)


def test_fitted_grammars_read_threats_before_targets(spark):
    rows = [(i, f"the snark number {i} v{i}w here" if i % 2 else f"number {i} v{i}w is fine", i % 2) for i in range(80)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    cases = spark.createDataFrame([(1, "i will kill you"), (2, "i will see you")], "doc_id long, text string")
    found = by_id(toxicity.score(cases, toxicity.fit(docs, labels)))
    assert (found[1].n_toxic_clauses, found[2].n_toxic_clauses) == (1, 0)
    assert found[1].score > found[2].score


def test_signatures_of_short_texts_are_of_their_words():
    import pyarrow as pa

    texts = ["one two", "three", "One two", "a b c d", "", None, "one two"]
    some = toxicity._signature(pa.array(texts))
    turned = toxicity._signature(pa.array(texts[::-1]))
    assert some == turned[::-1] and some[0] == some[2] == some[6] and some[4] == some[5]
    assert len(set(some)) == 4


def test_toxicity_learns_from_labels(spark, docs, rows, no_docs, odd_docs):
    insults = ("blorg", "snark", "vexil")
    cases = [(i, f"{' '.join(r[1].split()[:60])} {insults[i % 3]}. and {insults[(i + 1) % 3]} too", 1) if i % 3 == 0
             else (i, r[1], 0) for i, r in enumerate((rows * 3)[:150]) if r[1] and r[1].split()]
    cases = [(i, f"{t} u{i}v u{i}w u{i}x u{i}y", y) for i, t, y in cases]
    table = spark.createDataFrame([c[:2] for c in cases], "doc_id long, text string")
    labels = spark.createDataFrame([(c[0], 1, c[2]) for c in cases], "doc_id long, quality int, toxic int")
    grammar = toxicity.fit(table, labels.filter(~held_out(F.col("doc_id"))))
    found = by_id(toxicity.score(table, grammar))
    assert all(found[i].predicted == y for i, _, y in cases)
    assert all(0 <= r.score <= 1 for r in found.values())
    assert toxicity.score(no_docs, grammar).count() == 0
    assert toxicity.score(odd_docs, grammar).count() == 8
    unlearned = toxicity.fit(docs, labels.limit(0))
    assert {r.predicted for r in toxicity.score(docs, unlearned).collect()} == {0}


# --- URLs -------------------------------------------------------------------

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def test_url_parts_and_rules(spark):
    cases = {
        "http://A.Example.NET/en/1?q=/x": ("a.example.net", "/en/1", "example.net/en/"),
        "https://example.net": ("example.net", "", None),
        "https://badexample.net/en/": ("badexample.net", "/en/", "net/"),
        "x://example.com/de/#a://b": ("example.com", "/de/", "example.com/de/"),
        "x://example.com/De/": ("example.com", "/De/", None),
        "http://sub.org/fr/a\nb": ("sub.org", "/fr/a\nb", "org/fr/"),
        "no scheme/net/": ("", "", None), "": ("", "", None), "://net/": ("net", "/", "net/"),
    }
    table = spark.createDataFrame([(u,) for u in [*cases, None]], "url string")
    found = {r.url: (r.host, r.path, r.rule) for r in
             url_rules.apply_rules(url_rules.host_and_path(table), RULES).collect()}
    assert found == {**cases, None: ("", "", None)}


def test_url_rules_are_mined_and_matched(spark):
    urls = [f"http://h{i % 7}.example.net/{'en' if i % 2 else 'de'}/{i}" for i in range(400)]
    urls += ["http://h1.example.com/en/1", "http://new.example.com/de/x", "http://new.site.com/xx/x", None, "bad"]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.url: r for r in url_rules.judge(table, RULES).collect()}
    assert len(found) == 405
    assert found["http://h1.example.com/en/1"].verdict == "allow"
    assert found["http://new.example.com/de/x"].rule == "example.com/de/"
    assert found["http://new.site.com/xx/x"].verdict == found[None].verdict == found["bad"].verdict == "allow"
    tokens = url_rules.apply_rules(url_rules.host_and_path(table), RULES).withColumn("tokens", url_rules.tokens())
    rules = url_rules.mine(tokens.filter("label IS NOT NULL").select("tokens", "label"))
    mined = {(tuple(r.tokens), r.verdict) for r in rules.collect()}
    assert (("folder:en",), "allow") in mined and (("folder:de",), "block") in mined
    assert url_rules.judge(table.limit(0), RULES).count() == 0
