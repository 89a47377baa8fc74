"""Benchmark leaks in documents, by greedy string tiling.

Test items are read in blocks of bounded size, so that a block's seeds (windows
of ``tile`` words) can be sent to all tasks. A document is scanned by rolling hash for
seeds; only pairs of document and item that share one go on. Seeds that continue
each other on one diagonal make a match. Tiling takes the longest match whose
words are all free, marks its words on both sides, and goes on with what is left
of the others, until no match of ``tile`` words remains. An item has leaked if the
tiles cover at least ``coverage`` of its words: so passages whose sentences were
put in another order, or that lost some words, are found as well.

Words are runs of letters, digits and underscores, lower-cased. Null and empty
texts hold nothing; items with fewer words than a tile, and items of null text,
cannot be judged and never leak. Repeated items are reported each; repeated rows
of documents likewise. Without items there are no leaks.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanepulse.llm import shingles

#: Items whose texts make about so many bytes are sent to the tasks at a time.
BLOCK_BYTES = 8_000_000
_WORD = re.compile(r"\w+")
_U = np.uint64
_BASE = 0xD1342543DE82EF95


def _seeds(ids: np.ndarray, tile: int) -> np.ndarray:
    """Karp-Rabin value of the window at each place; 0 where it has an unknown word."""
    n = len(ids) - tile + 1
    if n <= 0:
        return np.zeros(0, _U)
    value, known = np.zeros(n, _U), np.ones(n, bool)
    for k in range(tile):
        part = ids[k:k + n]
        value = value * _U(_BASE) + shingles.mixed(part.astype(_U))
        known &= part > 0
    return np.where(known, value | _U(1), _U(0))


class Items:
    """A block of test items: word numbers, and their seeds in order of value."""

    def __init__(self, rows: list[tuple[int, str]], tile: int):
        self.tile, self.number = tile, {}
        self.item = [r[0] for r in rows]
        words = [_WORD.findall(r[1].lower()) for r in rows]
        self.length = [len(w) for w in words]
        value, item, place = [], [], []
        for i, w in enumerate(words):
            ids = np.array([self.number.setdefault(x, len(self.number) + 1) for x in w], np.int64)
            seeds = _seeds(ids, tile)
            value.append(seeds)
            item.append(np.full(len(seeds), i))
            place.append(np.arange(len(seeds)))
        value = np.concatenate([np.zeros(0, _U), *value])
        order = np.argsort(value, kind="stable")
        self.value = value[order]
        self.of = np.concatenate([np.zeros(0, np.int64), *item])[order]
        self.place = np.concatenate([np.zeros(0, np.int64), *place])[order]

    def hits(self, texts: list[str]) -> dict[tuple[int, int], list[tuple[int, int]]]:
        """(text, item) to the (place in item, place in text) of shared seeds."""
        get = self.number.get
        ids = [[get(w, 0) for w in _WORD.findall(t.lower())] for t in texts]
        first = np.cumsum([0, *(len(x) + 1 for x in ids)])
        flat = np.zeros(first[-1], np.int64)  # an unknown word ends each text
        for a, x in zip(first.tolist(), ids, strict=False):
            flat[a:a + len(x)] = x
        seeds = _seeds(flat, self.tile)
        low = np.searchsorted(self.value, seeds, "left")
        high = np.searchsorted(self.value, seeds, "right")
        found: dict = defaultdict(list)
        for at in np.flatnonzero((high > low) & (seeds > 0)).tolist():
            text = int(np.searchsorted(first, at, "right")) - 1
            for k in range(low[at], high[at]):
                found[text, int(self.of[k])].append((int(self.place[k]), at - int(first[text])))
        return found


def tiles(hits: list[tuple[int, int]], length: int, tile: int) -> list[tuple[int, int, int]]:
    """(place in item, place in text, words) of the tiles, longest first."""
    queue = []
    by_diagonal = defaultdict(list)
    for a, b in hits:
        by_diagonal[b - a].append(a)
    for diagonal, places in by_diagonal.items():
        places.sort()
        start = before = places[0]
        for a in [*places[1:], None]:
            if a is None or a != before + 1:
                heapq.heappush(queue, (-(before - start + tile), start, start + diagonal))
                start = a
            before = a
    free = np.ones(length, bool)
    taken: set[int] = set()
    out = []
    while queue:
        size, a, b = heapq.heappop(queue)
        size = -size
        open_ = [bool(free[a + k]) and b + k not in taken for k in range(size)]
        if all(open_):
            out.append((a, b, size))
            free[a:a + size] = False
            taken.update(range(b, b + size))
            continue
        k = 0
        while k < size:  # what is left of the match goes back into the queue
            end = k
            while end < size and open_[end]:
                end += 1
            if end - k >= tile:
                heapq.heappush(queue, (-(end - k), a + k, b + k))
            k = end + 1
    return out


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The items, some ``BLOCK_BYTES`` at a time."""
    items = items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).filter("t IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    for k in range(blocks):
        part = F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k
        yield [tuple(r) for r in items.filter(part).orderBy("i", "t").collect()]


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", tile: int = 5,
          coverage: float = 0.5) -> DataFrame:
    """(id, item, n_words, n_covered, n_tiles, spans) of each leaked item of a document.

    ``spans`` are the tiles as (first word, number of words) in the document.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    item_type = items.schema[item_col].dataType
    schema = (f"`{id_col}` {id_type}, `{item_col}` {item_type.simpleString()}, n_words long, n_covered long, "
              "n_tiles long, spans array<struct<start:long,n:long>>")
    names = [id_col, item_col, "n_words", "n_covered", "n_tiles", "spans"]
    spark = docs.sparkSession
    source = docs.select(id_col, text_col)
    result = spark.createDataFrame([], schema)
    for rows in _blocks(items, item_col, item_text_col):
        block = spark.sparkContext.broadcast(Items(rows, tile))
        result = result.unionByName(source.mapInArrow(_scan(block, names, item_type, tile, coverage), schema))
    return result


def _scan(block, names: list[str], item_type, tile: int, coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = block.value
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for a, b in shingles.slices(texts):
                part = [t or "" for t in texts.slice(a, b - a).to_pylist()]
                rows, out = [], []
                for (text, item), hits in sorted(known.hits(part).items()):
                    n = known.length[item]
                    found = tiles(hits, n, tile)
                    covered = sum(size for _, _, size in found)
                    if covered >= coverage * n:
                        rows.append(a + text)
                        out.append((known.item[item], n, covered, len(found),
                                    [{"start": s, "n": size} for _, s, size in sorted(found, key=lambda x: x[1])]))
                if rows:
                    item, n, covered, count, spans = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([
                        ids.take(pa.array(rows)), pa.array(item), pa.array(n, pa.int64()),
                        pa.array(covered, pa.int64()), pa.array(count, pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int64())])))],
                        names=names)

    return run


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **kwargs) -> DataFrame:
    """``docs`` without those in which an item has leaked. Rows of a null id stay."""
    found = leaks(docs, items, id_col, **kwargs).select(id_col).distinct()
    return docs.join(found, id_col, "left_anti")
