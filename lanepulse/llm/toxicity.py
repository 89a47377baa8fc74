"""Toxic clauses by a weighted grammar of small transducers.

A clause (text between sentence marks, commas stay inside) is read as a string of symbols:
``I`` a word with an insulting stem, ``T`` a threat, ``Y`` a target, ``N`` a
negation, ``R`` reported speech, ``.`` any other word. Five transducers read it
side by side, composed into one machine: insult and threat emit weight, target
raises what the clause emits, negation lowers the next few words, reported speech
lowers the rest of the clause. A threat counts with a target or an insult in its
clause only; until one comes it is held back. A clause's score is the sum of what
it emits; a clause without insult or threat has no score, whatever words stand in it.
A grammar that is not fitted looks for targets and insults before a word only
(``behind``).

Stems and their weights (log odds) are learned from labels, as are the three
numbers that turn a text's clause scores into a probability. Both are fitted on a
bounded sample of labelled rows: the first ``SAMPLE`` in the order of a hash. One row
is taken of texts with the same smallest hash of four words, so copies do not
count twice. The probabilities are fitted on halves read with the other's stems.

Null, empty and wordless texts get the score of a text without matched clauses.
If the sample lacks toxic or clean rows, every score is the share of toxic ones (0
without labels). Repeated rows are scored alike. Columns ``score`` and ``predicted``
are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanepulse.llm import shingles
from lanepulse.llm.common import written

#: Labelled rows that are fitted on.
SAMPLE = 20_000
#: A stem needs this share of the toxic rows, so many of them, and such log odds.
MIN_SHARE, MIN_ROWS, MIN_ODDS = 0.01, 3, 3.0
#: Stems by which each toxic row is to be reached.
REACHED = 5
STEM_LENGTHS = range(3, 9)
MOST_STEMS = 2_000
REMEMBERED = 400_000
PREDICT_AT = 0.3

#: Fixed word lists of the grammar.
THREATS = frozenset("kill hurt destroy beat burn stab shoot strangle töten schlagen vernichten tuer frapper "
                    "détruire matar golpear destruir".split())
TARGETS = frozenset("you your yours u he she they them these those people everyone du dich dein ihr euch "
                    "tu toi vous ils elles tú usted ustedes ellos".split())
NEGATIONS = frozenset("not no never isn aren wasn don doesn nicht kein keine nie pas jamais nunca jamás".split())
REPORTS = frozenset("said says wrote claimed quoted reported called sagte schrieb dit écrit dijo escribió".split())
#: Words that a negation reaches, and what the transducers multiply by.
REACH = 3
NEGATED, REPORTED, TARGETED = 0.3, 0.5, 1.25
THREAT_WEIGHT = 3.0

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]")
_WORD = re.compile(r"[^\W\d_]+")


def stems(word: str) -> list[str]:
    """The word and its beginnings; ``$`` marks a whole word."""
    return [word + "$", *(word[:k] for k in STEM_LENGTHS if k < len(word))]


@dataclass
class Grammar:
    """Learned stems, and the weights of base, strength and number of clauses."""

    weights: dict[str, float] = field(default_factory=dict)
    base: float = -30.0
    strength: float = 0.0
    clauses: float = 0.0
    #: Whether a target or insult behind a word counts as one before it; fitted grammars do so.
    behind: bool = False

    def __post_init__(self):
        self.known: dict[str, tuple[str, float]] = {}

    def symbol(self, word: str) -> tuple[str, float]:
        if word in self.known:
            return self.known[word]
        best = max((self.weights.get(s, 0.0) for s in stems(word)), default=0.0)
        if best > 0:
            out = ("I", best)
        elif word in THREATS:
            out = ("T", THREAT_WEIGHT)
        else:
            out = next(((s, 0.0) for s, some in (("Y", TARGETS), ("N", NEGATIONS), ("R", REPORTS))
                        if word in some), (".", 0.0))
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        self.known[word] = out
        return out

    def clause(self, symbols: list[tuple[str, float]]) -> float:
        """What the composed machine emits.

        Its state is (reach of a negation, reported, target, weight of threats held back,
        weight emitted that a target would raise).
        """
        negated, reported, targeted, total, held, plain = 0, False, False, 0.0, 0.0, 0.0
        for kind, weight in symbols:
            if kind in "IT":
                weight *= (NEGATED if negated else 1.0) * (REPORTED if reported else 1.0)
                if targeted:
                    total += weight * TARGETED
                elif kind == "T" and not total:
                    held += weight
                else:
                    if self.behind:
                        weight, held = weight + held, 0.0
                    total, plain = total + weight, plain + weight
            elif kind == "Y" and self.behind:
                total += held * TARGETED + plain * (TARGETED - 1.0)
                held, plain = 0.0, 0.0
            negated = REACH if kind == "N" else max(0, negated - 1)
            reported |= kind == "R"
            targeted |= kind == "Y"
        return total

    def read(self, text: str | None) -> tuple[float, int]:
        """Sum of the clause scores, and the number of matched clauses."""
        low = (text or "").lower()
        symbol = self.symbol
        if not any(symbol(w)[0] in "IT" for w in _WORD.findall(low)):
            return 0.0, 0
        total, matched, clause = 0.0, 0, []
        for token in [*_TOKEN.findall(low), "."]:
            if token[0].isalpha():
                clause.append(symbol(token))
            else:
                score = self.clause(clause)
                total, matched, clause = total + score, matched + (score > 0), []
        return total, matched

    def probability(self, total: float, matched: int) -> float:
        x = self.base + self.strength * math.log1p(total) + self.clauses * math.log1p(matched)
        return 1.0 / (1.0 + math.exp(-min(30.0, max(-30.0, x))))


def _signature(texts: pa.Array) -> list[int]:
    """The smallest hash of four words in each text, of all words if there are fewer.

    Mostly the same for copies.
    """
    out = []
    for a, b in shingles.slices(texts):
        words = shingles.split(texts.slice(a, b - a), lower=True)
        value, fits = shingles.windows(words, 4)
        whole = shingles.spans(words, words.first[:-1], words.first[1:])
        for k in range(b - a):
            own = value[words.first[k]:words.first[k + 1]][fits[words.first[k]:words.first[k + 1]]]
            out.append(int((own.min() if len(own) else whole[k]).view(np.int64)))
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                    size: int) -> DataFrame:
    """(id, text, label, signature) of at most ``size`` labelled rows."""
    chosen = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()) \
        .groupBy(id_col).agg(F.max(label_col).cast("int").alias("label")) \
        .orderBy(F.xxhash64(F.lit(5), id_col), id_col).limit(size)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .join(F.broadcast(chosen.withColumnRenamed(id_col, "id")), "id").select(
            F.col("id").cast("string").alias("id"), "text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(_signature(batch.column("text")), pa.int64())],
                names=["id", "text", "label", "signature"])

    return rows.mapInArrow(run, "id string, text string, label int, signature long")


def _stem_rows(rows: DataFrame) -> DataFrame:
    """(stem, toxic, clean): in how many rows of each label a stem occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = set(_WORD.findall((text or "").lower()))
                seen[label != 0].update({s for w in words for s in stems(w)})
            names = list(seen[0] | seen[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array([seen[k][s] for s in names], pa.int64()) for k in (1, 0))],
                names=["stem", "toxic", "clean"])

    return rows.select("text", "label").mapInArrow(run, "stem string, toxic long, clean long") \
        .groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", size: int = SAMPLE) -> Grammar:
    """The grammar learned from a bounded sample of labelled rows."""
    sample = written(labelled_sample(docs, labels, id_col, text_col, label_col, size), "toxic-sample")
    # one row for each signature and label
    alike = sample.groupBy("signature", "label").agg(F.min("id").alias("id"))
    sample = written(sample.join(alike, ["signature", "label", "id"]), "toxic-rows")
    n = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        share = min(max(toxic / max(1, toxic + clean), 1e-9), 1 - 1e-9)
        return Grammar(base=math.log(share / (1 - share)), behind=True)
    half = F.pmod(F.xxhash64("signature"), F.lit(2))
    # each half is read with the stems of the other
    read = [r for k in (0, 1) for r in _read(sample.filter(half == k), _learn(sample.filter(half != k)))]
    return Grammar(_learn(sample), *_logistic(read), behind=True)


def _learn(rows: DataFrame) -> dict[str, float]:
    """Weights of the stems that tell toxic rows, each needed for some of them.

    Among the stems with good odds, those are taken first that reach most rows not
    yet reached twice; so stems that only accompany others by chance are left out.
    """
    n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    least = max(MIN_ROWS, MIN_SHARE * toxic)
    odds = F.log((F.col("toxic") + 0.5) / F.lit(toxic + 1)) - F.log((F.col("clean") + 0.5) / F.lit(clean + 1))
    found = _stem_rows(rows).withColumn("odds", odds).filter(
        (F.col("toxic") >= least) & (F.col("odds") >= MIN_ODDS) & (F.col("toxic") >= 10 * F.col("clean"))) \
        .orderBy(F.desc(F.col("odds") * F.col("toxic")), "stem").limit(MOST_STEMS).collect()
    weights = {r["stem"]: float(r["odds"]) for r in found}
    holders: dict[str, set[int]] = {s: set() for s in weights}
    for i, row in enumerate(rows.filter("label <> 0").select("text").toLocalIterator()):
        for word in set(_WORD.findall((row["text"] or "").lower())):
            for stem in stems(word):
                if stem in holders:
                    holders[stem].add(i)
    reached: Counter = Counter()
    chosen: dict[str, float] = {}
    while holders:
        gain = {s: sum(reached[i] < REACHED for i in rows_) for s, rows_ in holders.items()}
        best = max(gain, key=lambda s: (gain[s] * weights[s], s))
        if gain[best] < max(MIN_ROWS, least / 4):
            break
        chosen[best] = weights[best]
        reached.update(holders.pop(best))
    return chosen


def _read(rows: DataFrame, weights: dict[str, float]) -> list[tuple[float, int, int]]:
    """(strength, matched clauses, label) of each of a bounded number of rows."""
    sent = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Grammar(sent.value, behind=True)
        for batch in batches:
            read = [reader.read(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in read], pa.float64()), pa.array([r[1] for r in read], pa.int64()),
                batch.column(1)], names=["total", "matched", "label"])

    found = rows.select("text", "label").mapInArrow(run, "total double, matched long, label int")
    return [tuple(r) for r in found.collect()]


def _logistic(read: list[tuple[float, int, int]]) -> tuple[float, float, float]:
    """Logistic regression by Newton's method, held by a small penalty."""
    y = np.array([float(label != 0) for _, _, label in read])
    x = np.array([[1.0, math.log1p(total), math.log1p(matched)] for total, matched, _ in read])
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - 0.1 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        w = w + np.linalg.solve(bend, slope)
    return tuple(map(float, w))


def score(docs: DataFrame, grammar: Grammar, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and ``n_toxic_clauses``."""
    base = docs.drop("score", "predicted", "n_toxic_clauses")
    sent = base.sparkSession.sparkContext.broadcast(grammar)
    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
             T.StructField("n_toxic_clauses", T.LongType())]
    names = [*base.columns, *(f.name for f in added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = sent.value
        for batch in batches:
            read = [reader.read(t) for t in batch.column(text_col).to_pylist()]
            p = [reader.probability(*r) for r in read]
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array(p, pa.float64()),
                pa.array([int(x >= PREDICT_AT) for x in p], pa.int32()),
                pa.array([r[1] for r in read], pa.int64())], names=names)

    return base.mapInArrow(run, T.StructType([*base.schema.fields, *added]))
