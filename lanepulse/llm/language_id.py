"""Language by unigrams of pieces, summed over all segmentations of a word.

The pieces are a public vocabulary; it is fixed. ``fit`` counts, per language, the
pieces of all words that the labelled rows hold, in the vocabulary's own
segmentation, and makes smoothed probabilities of them. ``predict`` does not pick
a segmentation: a forward pass over a word adds up the probabilities of all ways
to cut it into pieces, per language. A text's score is the posterior of its best
language, with equal priors.

What is counted covers all labelled rows and grows with them; what is sent to the
tasks is a probability per piece and language. Words are remembered per worker up
to ``REMEMBERED``, for speed only.

Words are runs of letters (Unicode L), lower-cased, whole whatever their length; sums
are rescaled on the way, so that long words do not vanish. A text without letters, or
null, is ``und`` with score 0; so is every text if no language was learned.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WORD = re.compile(r"[^\W\d_]+")
REMEMBERED = 400_000
#: Letters of remembered words, and letters times words of a forward pass.
_LETTERS, _PASS = 16_000_000, 131_072
#: Letters after which sums are rescaled; a letter costs a factor of 1e-12 at most.
_RESCALED = 16
#: Added to each piece's count.
SMOOTHING = 0.5
UNKNOWN = "und"
_START = "▁"


def words_of(text: str | None) -> list[str]:
    found = _WORD.findall((text or "").lower())
    if not all(map(str.isalpha, found)):  # numerals such as ½ pass the pattern
        found = [p for w in found for p in "".join(c if c.isalpha() else " " for c in w).split()]
    return found


_processors: dict = {}


def _processor(path: str):
    if path not in _processors:
        import sentencepiece

        _processors[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _processors[path]


def piece_counts(rows: DataFrame, path: str, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, piece, n): how often each language's words hold each piece."""
    def counted(seen: dict[str, Counter]) -> pa.RecordBatch:
        langs, ids, counts = [], [], []
        for lang, words in seen.items():
            pieces: Counter = Counter()
            keys = list(words)
            for start in range(0, len(keys), 20_000):
                some = keys[start:start + 20_000]
                for word, found in zip(some, _processor(path).encode(some, num_threads=1), strict=True):
                    n = words[word]
                    for i in found:
                        pieces[i] += n
            langs += [lang] * len(pieces)
            ids += pieces.keys()
            counts += pieces.values()
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(ids, pa.int64()), pa.array(counts, pa.int64())],
            names=["lang", "piece", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seen.setdefault(lang, Counter()).update(words_of(text.as_py()))
                if sum(map(len, seen.values())) > REMEMBERED:
                    yield counted(seen)
                    seen = {}
        if seen:
            yield counted(seen)

    return rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")) \
        .mapInArrow(run, "lang string, piece long, n long") \
        .groupBy("lang", "piece").agg(F.sum("n").alias("n"))


def fit(rows: DataFrame, path: str, lang_col: str = "lang", text_col: str = "text") -> dict:
    """Languages in order, and the log probability of each piece in each of them.

    The driver gets at most one row per language and piece of the vocabulary.
    """
    labelled = rows.filter(F.col(lang_col).isNotNull())
    counts = piece_counts(labelled, path, lang_col, text_col).collect()
    langs = sorted({r["lang"] for r in counts})
    place = {lang: i for i, lang in enumerate(langs)}
    processor = _processor(path)
    size = processor.get_piece_size()
    table = np.full((size, len(langs)), SMOOTHING)
    for lang, piece, n in counts:
        table[piece, place[lang]] += n
    logs = np.log(table / table.sum(axis=0)) if langs else table
    pieces = {
        processor.id_to_piece(i): tuple(logs[i].tolist()) for i in range(size)
        if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i))}
    # a letter outside the vocabulary is as likely as a piece never seen
    rare = tuple((math.log(SMOOTHING) - np.log(table.sum(axis=0))).tolist()) if langs else ()
    return {"langs": langs, "pieces": pieces, "rare": rare}


class Scorer:
    """Log probabilities of words, summed over segmentations, many words at a time."""

    #: Of this Python worker: the scorer in use, so that it serves several tasks.
    current: tuple[str, Scorer] | None = None

    @classmethod
    def shared(cls, token: str, model: dict) -> Scorer:
        if cls.current is None or cls.current[0] != token:
            cls.current = (token, cls(model))
        return cls.current[1]

    def __init__(self, model: dict):
        self.langs = model["langs"]
        self.rare = np.exp(np.array(model["rare"], float))
        chance = np.array(list(model["pieces"].values()), float)
        self.chance = np.exp(chance.reshape(len(model["pieces"]), len(self.langs)))
        # pieces as a tree: an edge is (node, letter), a node may end a piece
        nodes: dict[tuple[int, str], int] = {}
        ends: list[int] = [-1]
        for row, piece in enumerate(model["pieces"]):
            node = 0
            for letter in piece:
                if (node, letter) not in nodes:
                    nodes[node, letter] = len(ends)
                    ends.append(-1)
                node = nodes[node, letter]
            ends[node] = row
        self.ends = np.array(ends)
        self.longest = max(map(len, model["pieces"]), default=1)
        keys = np.array([(n << 21) + ord(c) for n, c in nodes], np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.int64(2**62))
        self.to = np.append(np.array(list(nodes.values()), np.int64)[order], 0)
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.letters = 0
        self.table = np.zeros((0, len(self.langs)))

    def words(self, words: list[str]) -> np.ndarray:
        """A row of log probabilities for each word."""
        out = np.zeros((len(words), len(self.langs)))
        by_length = sorted(range(len(words)), key=lambda i: len(words[i]))
        while by_length:
            # the longest words that are left, few if they are long
            some = by_length[-max(1, min(4096, _PASS // (len(words[by_length[-1]]) + 1))):]
            del by_length[-len(some):]
            out[some] = self._forward([_START + words[i] for i in some])
        return out

    def _forward(self, marked: list[str]) -> np.ndarray:
        length = np.array([len(w) for w in marked])
        most = int(length[-1])
        letters = np.frombuffer("".join(w.ljust(most, "\0") for w in marked).encode("utf-32-le"), np.uint32)
        letters = letters.reshape(len(marked), most).astype(np.int64)
        # forward[i]: the sum over all ways to cut the first i letters, times exp(-scale)
        forward = np.zeros((most + 1, len(marked), len(self.langs)))
        forward[0] = 1.0
        scale, out = np.zeros((len(marked), 1)), np.zeros((len(marked), len(self.langs)))
        for i in range(most + 1):
            if i % _RESCALED == _RESCALED - 1:
                top = forward[i].max(axis=1, keepdims=True)
                top[top == 0] = 1.0  # words that have ended
                forward[i:i + self.longest + 1] /= top
                scale += np.log(top)
            ended = length == i
            # a language may be out of reach of a double by now
            out[ended] = np.log(np.maximum(forward[i][ended], 1e-300)) + scale[ended]
            at = np.flatnonzero(length > i)
            node = np.zeros(len(at), np.int64)
            for j in range(i, most):
                key = (node << 21) + letters[at, j]
                found = np.searchsorted(self.keys, key)
                known = self.keys[found] == key
                row = self.ends[self.to[found]]
                ends = known & (row >= 0)
                forward[j + 1][at[ends]] += forward[i][at[ends]] * self.chance[row[ends]]
                if j == i:  # a letter that is no piece
                    forward[j + 1][at[~ends]] += forward[i][at[~ends]] * self.rare
                at, node = at[known], self.to[found[known]]
                if not len(at):
                    break
        return out

    def texts(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        for k in range(0, len(texts), 256):
            yield from self._texts([words_of(t) for t in texts[k:k + 256]])

    def _texts(self, split: list[list[str]]) -> Iterator[tuple[str, float]]:
        if self.langs:
            if len(self.place) > REMEMBERED or self.letters > _LETTERS:
                self.forget()
            new = list(set().union(*split).difference(self.place))
            self.letters += sum(map(len, new))
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
            self.table = np.concatenate([self.table, self.words(new)])
        for words in split:
            if not words or not self.langs:
                yield UNKNOWN, 0.0
                continue
            total = self.table[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))].sum(axis=0)
            best = int(np.argmax(total))
            yield self.langs[best], float(1 / np.exp(total - total[best]).sum())


def predict(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; ties go to the first language."""
    base = docs.drop("lang_pred", "score")
    sent = base.sparkSession.sparkContext.broadcast(model)
    names = [*base.columns, "lang_pred", "score"]
    token = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer.shared(token, sent.value)
        for batch in batches:
            done = list(scorer.texts(batch.column(text_col).to_pylist()))
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array([x[0] for x in done], pa.string()),
                pa.array([x[1] for x in done], pa.float64())], names=names)

    return base.mapInArrow(run, T.StructType([
        *base.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
