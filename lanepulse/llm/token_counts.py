"""Token counts by prefix: one encoding answers every later length question.

White space ends a token in the vocabulary used here, so a text's count is the
sum over its chunks between blanks. The counts at every prefix of each distinct
chunk come from the tokenizer's own library and are remembered; with the sums
over the chunks before it they give the exact count at every prefix of the text.
``tokens_at`` and ``cut_at`` answer truncation and budget questions from the stored
counts without encoding again; ``tokens_before`` does so for whole chunks.

Prefixes of plain words go to the library's model alone, each once; the whole words go
through all of the library as well, and the counts must agree. A long chunk (text without
blanks) is cut where the library's splitter cuts it, whatever follows. What is left, a
long run of letters or of marks, is read once from left to right: the last token of a
prefix is the one that ends there and stands after the last token of the prefix before it
without merging. Runs in which characters combine, or behind a contraction, are encoded
prefix by prefix.

A count may fall when a prefix grows, as more letters may make one token of several;
the longest prefix within a limit is the last one, whatever stands before it.

Null and empty texts have no tokens and empty prefix lists. Special strings in a
text count as the library counts them by default. Repeated rows are counted
alike; new columns replace columns of the same name.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Distinct chunks, and prefixes of them, remembered per Python worker, each about 150 MB.
REMEMBERED = 1_000_000
#: Characters handled at once.
_SLICE = 2_000_000
#: Marks that the vocabulary splits off a word of plain letters.
_MARKS = ".,;:!?"
#: Longer chunks are not remembered, and split before their prefixes are encoded.
_SHORT = 48
#: First letters of what makes a piece of its own with an apostrophe before it.
_CONTRACTED = frozenset("strvmld")


@functools.cache
def _combining() -> frozenset[str]:
    """Characters that may change or move what stands before them (NFC)."""
    # no character beyond the supplementary ideographic plane decomposes
    pairs = (unicodedata.decomposition(chr(c)).split() for c in range(0x30000))
    seconds = {chr(int(p[1], 16)) for p in pairs if len(p) == 2 and p[0][0] != "<"}
    jamo = {chr(c) for a, b in ((0x1161, 0x1176), (0x11A8, 0x11C3)) for c in range(a, b)}
    return frozenset(seconds | jamo)


class _Pieces:
    """The vocabulary's tokens, and which of them can stand next to each other."""

    def __init__(self, model: dict):
        self.ends = model["end_of_word_suffix"]
        self.vocab = frozenset(model["vocab"])
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {tuple(m): k for k, m in reversed(list(enumerate(pairs)))}
        self.longest = max(map(len, self.vocab))
        self.alone: dict[tuple[str, str], bool] = {}

    def stand(self, before: str, token: str) -> bool:
        """Whether the merges of all symbols end with these two tokens, or the one if the first is empty."""
        pair = (before, token)
        if pair not in self.alone:
            if len(self.alone) >= REMEMBERED:
                self.alone.clear()
            last = token.removesuffix(self.ends)
            parts = list(before + last)
            parts[-1] += token[len(last):]
            none, rank = len(self.rank), self.rank.get
            while len(parts) > 1:
                ranks = [rank(p, none) for p in zip(parts, parts[1:])]
                best = min(ranks)
                if best == none:
                    break
                k = ranks.index(best)
                parts[k:k + 2] = [parts[k] + parts[k + 1]]
            self.alone[pair] = parts == ([before, token] if before else [token])
        return self.alone[pair]

    def counts(self, symbols: str, ends: list[int]) -> list[int]:
        """Tokens of the first ``n`` symbols as a word, for each ``n`` in ``ends``."""
        last: list[str] = [""]
        count = [0]

        def step(end: int, suffix: str) -> tuple[str, int]:
            for size in range(1, min(end, self.longest) + 1):
                token = symbols[end - size:end] + suffix
                before = last[end - size]
                if token in self.vocab and self.stand(before, token):
                    return token, count[end - size] + 1
            raise ValueError("no token ends here")

        for end in range(1, len(symbols) + 1):
            token, n = step(end, "")
            last.append(token)
            count.append(n)
        return [step(end, self.ends)[1] for end in ends]


class ChunkCounter:
    """Counts at the prefixes of distinct chunks, from the library, remembered per worker."""

    shared_by_path: dict[str, ChunkCounter] = {}

    @classmethod
    def shared(cls, path: str) -> ChunkCounter:
        if path not in cls.shared_by_path:
            cls.shared_by_path[path] = cls(path)
        return cls.shared_by_path[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.path = path
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        # 32-bit counts at each prefix, the last one twice: the blank behind adds nothing
        self.known: dict[str, bytes] = {}
        self.shapes: dict[bytes, bytes] = {}
        self.starts: dict[str, int] = {}  # prefixes of many words are the same
        self.kinds: dict[str, str] = {}
        self.letters: dict[str, str] = {}
        self.forget()

    def forget(self) -> None:
        self.known, self.shapes, self.starts = {"": bytes(4)}, {}, {}

    @functools.cached_property
    def pieces(self) -> _Pieces:
        with open(self.path, encoding="utf-8") as file:
            return _Pieces(json.load(file)["model"])

    @staticmethod
    def parts(chunk: str) -> tuple[str, str]:
        """A plain lower-cased word and the mark behind it, else the chunk as it is."""
        if not chunk.isascii():
            return chunk, ""
        low = chunk.lower()
        if low[-1] in _MARKS and low[:-1].isalpha():
            return low[:-1], low[-1]
        return low if low.isalpha() else chunk, ""

    def _totals(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        for start in range(0, len(texts), 10_000):
            out += map(len, self.tokenizer.encode_batch_fast(texts[start:start + 10_000], add_special_tokens=False))
        return out

    def _encoded(self, text: str) -> list[int]:
        return self._totals([text[:k] for k in range(1, len(text) + 1)])

    def kind(self, char: str) -> str:
        """L, N, M as the splitter takes a character, a blank, or ? if it takes it apart."""
        if char not in self.kinds:
            split = self.tokenizer.pre_tokenizer.pre_tokenize_str
            plain = self.tokenizer.normalizer.normalize_str(char)
            if len(plain) != 1:
                self.kinds[char] = "?"
            elif not split(plain):
                self.kinds[char] = " "
            elif len(split("a" + plain)) == 1:
                self.kinds[char] = "L"
            else:
                self.kinds[char] = "N" if len(split(plain + plain)) == 2 else "M"
        return self.kinds[char]

    def _inert(self, char: str) -> bool:
        return char.isascii() or not (unicodedata.combining(char) or char in _combining())

    def _cuts(self, text: str) -> list[int]:
        """Places where the splitter starts anew whatever follows, and the ends."""
        cuts = [0]
        for k in range(1, len(text)):
            before, here = text[k - 1], text[k]
            a, b = self.kind(before), self.kind(here)
            if "?" in (a, b) or not self._inert(here) or a == b != "N" and a != " ":
                continue
            if before == "'" and here.lower() in _CONTRACTED:
                continue
            cuts.append(k)
        return [*cuts, len(text)]

    def _run(self, text: str) -> list[int]:
        """Counts at each prefix of what lies between two cuts."""
        kinds = {self.kind(c) for c in text}
        if len(text) <= _SHORT or kinds not in ({"L"}, {"M"}) or not all(map(self._inert, text)):
            return self._encoded(text)
        plain = [self.tokenizer.normalizer.normalize_str(c) for c in text]
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str("".join(plain))
        ends = np.cumsum([len(c.encode()) for c in plain]).tolist()
        if len(split) != 1 or len(split[0][0]) != ends[-1]:
            return self._encoded(text)
        return self.pieces.counts(split[0][0], ends)

    def _plain(self, text: str) -> list[int]:
        """Counts at each prefix of a text in which no special string is complete."""
        out, total = [], 0
        cuts = self._cuts(text)
        for a, b in zip(cuts, cuts[1:]):
            out += (total + n for n in self._run(text[a:b]))
            total = out[-1] if out else 0
        return out

    def at_prefixes(self, chunk: str) -> list[int]:
        """Counts at each prefix of a chunk of any length."""
        out, total = [], 0
        parts = self.special.split(chunk) if self.special else [chunk]
        for text, special in zip(parts[::2], [*parts[1::2], ""]):
            # before it is complete, a special string is text like any other
            counts = self._plain(text + special[:-1])
            out += (total + n for n in counts)
            if special:
                total += (counts[len(text) - 1] if text else 0) + 1
                out.append(total)
        return out

    def _keep(self, counts: list[int]) -> bytes:
        shape = array("i", [*counts, counts[-1]]).tobytes()
        return self.shapes.setdefault(shape, shape)

    def symbols(self, char: str) -> str:
        """What the vocabulary has for a letter that stands for itself; empty for all else."""
        if char not in self.letters:
            plain = self.kind(char) == "L" and self._inert(char)
            split = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(char))
            self.letters[char] = split[0][0] if plain and len(split) == 1 else ""
        return self.letters[char]

    def _learn_words(self, new: set[str]) -> list[str]:
        """Learns the words of plain letters; returns the rest.

        The vocabulary's model counts their prefixes, without the normalizer and the splitter,
        which do nothing to them; a group of words for which the library counts otherwise is
        returned.
        """
        words, others = [], []
        for p in new:
            made = [self.symbols(c) for c in p]
            (words if all(made) else others).append((p, made))
        tokens = self.tokenizer.model.tokenize
        for k in range(0, len(words), 500):
            some, found, total = words[k:k + 500], [], self.starts
            if len(total) > REMEMBERED:
                total = self.starts = {}
            for _, made in some:
                text, counts = "", []
                for symbol in made:
                    text += symbol
                    if text not in total:
                        total[text] = len(tokens(text))
                    counts.append(total[text])
                found.append(counts)
            if sum(c[-1] for c in found) == self._totals([" ".join(p for p, _ in some)])[0]:
                self.known.update((p, self._keep(c)) for (p, _), c in zip(some, found, strict=True))
            else:
                others += some
        return [p for p, _ in others]

    def learn(self, chunks: set[str]) -> None:
        if len(self.known) + len(chunks) > REMEMBERED:
            self.forget()
        known = self.known
        parts = {c: self.parts(c) for c in chunks if c not in known}
        new = {p for pair in parts.values() for p in pair if p and p not in known}
        # chunks with signs or digits in them are sums over what the splitter makes of them
        joint = {p: [p[a:b] for a, b in zip(cuts, cuts[1:])] for p in new
                 if not (p.isalpha() or self.special and "<" in p) and len(cuts := self._cuts(p)) > 2}
        new = {x for x in (new - joint.keys()).union(*joint.values()) if x not in known}
        others = self._learn_words(new)
        starts = list({p[:k] for p in others for k in range(1, len(p) + 1)})
        total = dict(zip(starts, self._totals(starts), strict=True))
        for p in others:
            known[p] = self._keep([total[p[:k]] for k in range(1, len(p) + 1)])
        for p, made in joint.items():
            counts = np.zeros(len(p) + 1, np.int32)
            at = total_so_far = 0
            for x in made:
                own = np.frombuffer(known[x], np.int32)
                counts[at:at + len(own)] = own + total_so_far
                at, total_so_far = at + len(x), counts[at + len(own) - 1]
            shape = counts.tobytes()
            known[p] = self.shapes.setdefault(shape, shape)
        for c, (a, b) in parts.items():
            if b:
                shape = known[a] + (int.from_bytes(known[a][-4:], "little") + 1).to_bytes(4, "little")
                shape = known[a][:-4] + shape[-4:] * 2
                known[c] = self.shapes.setdefault(shape, shape)
            else:
                known[c] = known[a]

    def counts(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text: the end of each chunk, and the tokens of its first 1, 2, ... characters."""
        split = [t.replace("\n", " ").split(" ") if t else [] for t in texts]
        chunks = set().union(*split)
        self.learn({c for c in chunks if len(c) <= _SHORT})
        long = {}
        for c in chunks:
            if len(c) > _SHORT:
                own = self.at_prefixes(c)
                long[c] = np.array([*own, own[-1]], np.int32).tobytes()
        known = self.known

        def get(chunk: str) -> bytes:
            return known[chunk] if len(chunk) <= _SHORT else long[chunk]

        out = []
        for text in split:
            size = np.fromiter(map(len, text), np.int64, len(text)) + 1
            own = np.frombuffer(b"".join(map(get if long else known.__getitem__, text)), np.int32)
            ends = np.cumsum(size) - 1
            tokens = own[ends].astype(np.int64)
            out.append((ends, (own + np.repeat(np.cumsum(tokens) - tokens, size))[:-1]))
        return out


def _slices(texts: pa.Array) -> Iterator[list[str]]:
    batch, chars = [], 0
    for text in texts:
        value = text.as_py() or ""
        batch.append(value)
        chars += len(value)
        if chars >= _SLICE:
            yield batch
            batch, chars = [], 0
    if batch:
        yield batch


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", limit: int = 2048,
                 prefixes: bool = False, digest: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``cut_chars``, the longest prefix within ``limit``.

    With ``prefixes``, also ``prefix_counts``, the exact count of the first 1, 2, ...
    characters, and ``prefix_chars`` and ``prefix_tokens``: where each chunk ends, and the
    count up to there. With ``digest``, also ``prefix_sha256`` of ``prefix_counts`` as
    32-bit numbers, low byte first. ``path`` must be readable on executors.
    """
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("cut_chars", T.LongType())]
    if prefixes:
        added += [T.StructField("prefix_chars", T.ArrayType(T.LongType())),
                  T.StructField("prefix_tokens", T.ArrayType(T.LongType())),
                  T.StructField("prefix_counts", T.ArrayType(T.LongType()))]
    if digest:
        added.append(T.StructField("prefix_sha256", T.StringType()))
    names = {f.name for f in added}
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = ChunkCounter.shared(path)
        for batch in batches:
            totals, cuts, ends, sums, counts, digests = [], [], [], [], [], []
            for texts in _slices(batch.column(text_col)):
                for end, tokens in counter.counts(texts):
                    totals.append(int(tokens[-1]) if len(tokens) else 0)
                    if totals[-1] <= limit:
                        cuts.append(len(tokens))
                    else:
                        fits = np.flatnonzero(tokens <= limit)
                        cuts.append(int(fits[-1]) + 1 if len(fits) else 0)
                    if prefixes:
                        ends.append(end)
                        # a first chunk may be empty
                        sums.append(np.append(tokens, 0)[end - 1])
                        counts.append(tokens)
                    if digest:
                        digests.append(hashlib.sha256(tokens.astype("<u4")).hexdigest())
            columns = [*batch.columns, pa.array(totals, pa.int64()), pa.array(cuts, pa.int64())]
            if prefixes:
                columns += [pa.array(x, pa.list_(pa.int64())) for x in (ends, sums, counts)]
            if digest:
                columns.append(pa.array(digests, pa.string()))
            yield pa.RecordBatch.from_arrays(
                columns, names=[*batch.schema.names, *(f.name for f in added)])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *added]))


def tokens_before(chars: Column | int) -> Column:
    """Tokens of the chunks that end within the first ``chars`` characters."""
    limit = F.lit(chars) if isinstance(chars, int) else chars
    fit = F.size(F.filter("prefix_chars", lambda end: end <= limit))
    return F.coalesce(F.get("prefix_tokens", fit - 1), F.lit(0).cast("long"))


def tokens_at(chars: Column | int) -> Column:
    """Tokens of the first ``chars`` characters; of the whole text if it has fewer."""
    limit = F.lit(chars) if isinstance(chars, int) else chars
    last = F.least(limit, F.size("prefix_counts")).cast("int") - 1
    return F.coalesce(F.get("prefix_counts", last), F.lit(0).cast("long"))


def cut_at(budget: Column | int) -> Column:
    """Characters of the longest prefix with at most ``budget`` tokens."""
    limit = F.lit(budget) if isinstance(budget, int) else budget
    fits = F.transform("prefix_counts", lambda n, i: F.when(n <= limit, i + 1))
    return F.coalesce(F.array_max(fits), F.lit(0)).cast("long")
