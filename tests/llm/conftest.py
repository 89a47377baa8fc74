import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu", "ze") for b in ("ra", "ne", "so", "vi", "pu", "da")]


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    words = [pick.choice(WORDS) + pick.choice(("", "", ".", ",")) for _ in range(n)]
    return "".join(w + ("\n" if pick.random() < 0.05 else " ") for w in words).strip()


def mutated(text: str, seed: int, share: float) -> str:
    pick = random.Random(seed)
    return " ".join("changed" if pick.random() < share else w for w in text.split(" "))


def corpus() -> list[tuple]:
    """Plain, short, empty and null texts, copies, near copies, shared passages, a long text."""
    texts: list[str | None] = [prose(i, 20 + 17 * i % 300) for i in range(25)]
    texts += [texts[3], texts[3], texts[7], None, "", "  \n\t ", "one", "One two", "a b c d", "a b c d e", "A b C d e"]
    texts += [mutated(prose(100, 200), s, 0.01) for s in range(12)]
    texts += [mutated(prose(101, 150), s, 0.04) for s in range(8)]
    passage = prose(200, 70)
    texts += [prose(300 + s, 40) + "\n" + passage + "\n" + prose(400 + s, 30) for s in range(6)]
    short = ["w%d" % k for k in range(14)]
    texts += [" ".join(short), " ".join(short + ["x"]), " ".join(short[:-1]), " ".join(["y", *short])]
    texts += ["same words again " * 90, prose(500, 9000), "tail\x0bwith\x0cother\rspace\n\n end\n"]
    texts += ["é\u0301 ñandú 漢字 text with \x1c control and \u00a0 space"] * 2
    langs = ("en", "de", None)
    sources = ("s1", "s2", None, "s10", "s1")
    return [(i, t, langs[i % 3], sources[i % 5], len(t) if t else None) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids, one id twice, repeated rows, and columns named as the operators name theirs."""
    rows = [
        (None, "a null id with some words in it", "x"), (None, None, "x"), (5, "first text of five", "x"),
        (5, "second text of five", "x"), (6, "twice the same row", "x"), (6, "twice the same row", "x"),
        (7, "", "y"), (8, "x " * 5000, "y"),
    ]
    return spark.createDataFrame(
        [(i, t, "en", s, 1, 9, 9, "q", 0.5, "k", 7, 7) for i, t, s in rows],
        "doc_id long, text string, lang string, source string, n_words long, n_tokens long, size long, "
        "failures string, score double, kept_text string, n_lines long, pos long")
