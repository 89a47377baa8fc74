"""Similarity join on word shingles, light and heavy sets apart by cost.

Sets of up to ``x`` shingles are light: each lists the hashes of its subsets of
the size that a partner must share, so equal hashes are links and nothing is
verified. Larger sets are heavy: a pair of them must share one of the first
``n - ceil(t n) + 1`` shingles in a common order, so only those, and a tenth more,
are posted to inverted lists, and the lists are scanned. Sets of which others post
too few shingles are ruled out by count. The order puts the most frequent
shingles last (a bounded list of them, of which only the efficiency depends).
``x`` is the boundary with the least estimated cost, from the numbers of sets of
each small size.

Scanning the lists pair by pair would list all pairs of a group of copies. Here
equal sets are merged first. The sets of a list then form families (by the
smallest set of their lists), cut into chunks of bounded size. A task holds the
index of a chunk, counts the exact overlap of other sets with all of its sets
at once, and returns links only where they connect something new. First each
set meets one chunk of its family; then, wherever sets of different components
share a list, all but the largest component meet every chunk of that list.
So each pair that could link is connected already or has been compared.

Shingles are compared by 64 bits, sets and subsets by 128. Null and empty texts
have no shingles and link with nothing; a text with fewer words than a shingle
is one shingle. A null id counts as the largest, and rows with one id are one
document with several texts. Equal rows are copies. Where ids repeat, the join runs
on rows, told apart by id and a 64-bit hash of the text, so every text of an id meets
the others; for ``similar`` the rows of an id are linked to each other at the end.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanepulse.llm import shingles
from lanepulse.llm.common import LAST_ID, discard, likely, written
from lanepulse.llm.components import components

#: Frequent shingles known to all tasks: half a megabyte.
FREQUENT = 65_536
#: Shingles of a chunk of sets, and of the sets that meet it in one task.
CHUNK, MEETING = 65_536, 262_144
#: Largest boundary considered, and the cost of a posting in subset hashes.
MOST_LIGHT, POSTING_COST = 16, 4
#: Shingles whose frequency is counted at once in a task.
_COUNTED = 4_000_000
_U = np.uint64


class Threshold:
    """Jaccard similarity of at least ``num / den``, in whole numbers."""

    def __init__(self, percent: int):
        self.num, self.den = percent, 100

    def overlap(self, n: int, m: int) -> int:
        """Shingles that sets of these sizes must share."""
        return -(-self.num * (n + m) // (self.num + self.den))

    def prefix(self, n):
        return n - -(-self.num * n // self.den) + 1

    def posted(self, n):
        """The prefix and a tenth more: what is posted, so that lists can rule sets out."""
        return np.minimum(n, self.prefix(n) + n // 10)

    def partners(self, n: int) -> range:
        return range(-(-self.num * n // self.den), self.den * n // self.num + 1)

    def reach(self) -> str:
        """SQL: the largest partner of a set of ``n`` whose first common shingle stands at ``rank`` of it.

        All they share stands there or behind, ``n - rank`` at most, and must be their overlap.
        """
        return f"{self.num + self.den} * (n - rank) div {self.num} - n"

    def links(self, shared, n, m):
        return self.den * shared >= self.num * (n + m - shared)


def sets_of(texts: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ascending, and where each text's begin."""
    words = shingles.split(texts, lower=True)
    value, fits = shingles.windows(words, length)
    count = words.count()
    short = np.flatnonzero((count > 0) & (count < length))
    whole = shingles.spans(words, words.first[short], words.first[short + 1])
    value, text = np.append(value[fits], whole), np.append(words.text[fits], short)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return value[new], np.searchsorted(text[new], np.arange(len(texts) + 1))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, _U)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def _prints(values: np.ndarray, salt: int) -> np.ndarray:
    """Values to add up: a set's hash is the sum over its shingles."""
    return shingles.mixed(values ^ _U(0x5851F42D4C957F2D * (salt + 1) % 2**64))


def row_key(id_col: str, text_col: str) -> tuple[Column, Column]:
    """The document, and the row: rows with one id and one text are alike."""
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))
    return doc.alias("_doc"), F.xxhash64(F.lit(7), doc, F.coalesce(F.col(text_col), F.lit(""))).alias("_row")


def _input(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, id, row, t); ``doc`` is what the join takes as the id of a set."""
    doc, row = row_key(id_col, text_col)
    return docs.select(doc.alias("doc"), doc.alias("id"), row.alias("row"), F.col(text_col).alias("t"))


def _each_slice(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple]:
    """(ids, shingles, where each text's begin) per slice."""
    for batch in batches:
        doc, texts = batch.column("doc"), batch.column("t")
        for a, b in shingles.slices(texts):
            yield (doc.slice(a, b - a), *sets_of(texts.slice(a, b - a), length))


def signatures(source: DataFrame, length: int) -> DataFrame:
    """(id, row, n, set_a, set_b): size and hash of each row's set."""
    def run(batches):
        for batch in batches:
            texts = batch.column("t")
            for a, b in shingles.slices(texts):
                values, first = sets_of(texts.slice(a, b - a), length)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(a, b - a), batch.column("row").slice(a, b - a),
                    pa.array(np.diff(first)),
                    *(pa.array(_sums(_prints(values, s), first).view(np.int64)) for s in (0, 1))],
                    names=["id", "row", "n", "set_a", "set_b"])

    return source.select("id", "row", "t").mapInArrow(run, "id long, row long, n long, set_a long, set_b long")


def frequent(source: DataFrame, length: int) -> np.ndarray:
    """Up to ``FREQUENT`` shingles that many documents hold, sorted."""
    def run(batches):
        held: list[np.ndarray] = []
        total = 0

        def counted():
            value, n = np.unique(np.concatenate(held), return_counts=True)
            some = n >= 3
            return pa.RecordBatch.from_arrays(
                [pa.array(value[some].view(np.int64)), pa.array(n[some])], names=["shingle", "n"])

        for _, values, _ in _each_slice(batches, length):
            held.append(values)
            total += len(values)
            if total >= _COUNTED:
                yield counted()
                held, total = [], 0
        if held:
            yield counted()

    top = source.mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")) \
        .orderBy(F.desc("n"), "shingle").limit(FREQUENT).select("shingle")
    return np.sort(np.array([r[0] for r in top.collect()], np.int64).view(_U))


def _new_sets(seen: set, values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Texts whose set is not empty and is new to the task."""
    a, b = (_sums(_prints(values, s), first) for s in (0, 1))
    fresh = []
    for i, key in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        if first[i + 1] > first[i] and key not in seen:
            seen.add(key)
            fresh.append(i)
    return np.array(fresh, np.int64)


def postings(source: DataFrame, length: int, limit: Threshold, least: int, common) -> DataFrame:
    """(doc, shingle, rank): the first shingles of sets with at least ``least`` of them.

    What differs from row to row stands last, so that shuffle files are compressed well.
    """
    def run(batches):
        seen: set = set()
        often = common.value
        for doc, values, first in _each_slice(batches, length):
            size = np.diff(first)
            new = _new_sets(seen, values, first)
            new = new[size[new] >= least]
            wanted = np.zeros(len(size), np.int64)
            wanted[new] = limit.posted(size[new])
            late = np.isin(values, often) if len(often) else np.zeros(len(values), bool)
            text = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((late, text))  # stable: by hash within
            rank = np.arange(len(values)) - first[text]
            take = rank < wanted[text]
            yield pa.RecordBatch.from_arrays(
                [doc.take(pa.array(text[take])), pa.array(values[order][take].view(np.int64)),
                 pa.array(rank[take].astype(np.int32))], names=["doc", "shingle", "rank"])

    return source.mapInArrow(run, "doc long, shingle long, rank int")


def may_link(n: int, shared: np.ndarray, limit: Threshold) -> bool:
    """Whether a set of ``n`` shingles can link, given which of its posted ones others post.

    A partner of ``m`` shingles lacks at most ``n - o`` of them, ``o`` being the overlap
    they need. It has ``m - o`` shingles of its own at most, so the first ``posted(m) -
    (m - o)`` of this set come before the end of what the partner posted; those of them
    that the partner has are posted by both.
    """
    m = np.arange(limit.partners(n).start, limit.partners(n).stop)
    overlap = limit.overlap(n, m)
    known = np.minimum(limit.posted(n), limit.posted(m) - (m - overlap))
    alone = known - np.searchsorted(np.sort(shared), known)
    return bool((alone <= n - overlap).any())


def _possible(entries: DataFrame, sizes: DataFrame, limit: Threshold) -> DataFrame:
    """(node, n): the nodes of (node, rank) entries that can link at all.

    A node with sets of several sizes stays.
    """
    def run(batches):
        for batch in batches:
            ranks = batch.column("ranks")
            keep = [low < n or may_link(n, r.values.to_numpy(), limit) for n, low, r in zip(
                batch.column("n").to_pylist(), batch.column("low").to_pylist(), ranks, strict=True)]
            yield batch.select(["node", "n"]).filter(pa.array(keep, pa.bool_()))

    per_node = entries.groupBy("node").agg(F.collect_list("rank").alias("ranks")).join(sizes, "node")
    return per_node.select("node", "n", "low", "ranks").mapInArrow(run, "node long, n long")


def subset_tags(n: int, most: int, limit: Threshold) -> list[tuple[int, int, int]]:
    """(smaller size, larger size, subset size) for each partner of a light set."""
    pairs = {(min(n, m), max(n, m)) for m in limit.partners(n) if 0 < m <= most}
    return [(a, b, limit.overlap(a, b)) for a, b in sorted(pairs)]


def subset_hashes(source: DataFrame, length: int, limit: Threshold, most: int) -> DataFrame:
    """(tag, key_a, key_b, doc, smaller): subsets of sets with up to ``most`` shingles."""
    def run(batches):
        seen: set = set()
        for doc, values, first in _each_slice(batches, length):
            tags, keys, rows, smaller = [], ([], []), [], []
            size = np.diff(first)
            for i in _new_sets(seen, values, first):
                n = int(size[i])
                if n > most:
                    continue
                own = values[first[i]:first[i + 1]]
                prints = [_prints(own, s) for s in (0, 1)]
                for a, b, shared in subset_tags(n, most, limit):
                    left_out = np.array(list(itertools.combinations(range(n), n - shared)), np.int64)
                    left_out = left_out.reshape(math.comb(n, shared), n - shared)
                    for key, p in zip(keys, prints, strict=True):
                        key.append(p.sum(dtype=_U) - p[left_out].sum(axis=1, dtype=_U))
                    tags.append(np.full(len(left_out), a * 1000 + b))
                    rows.append(np.full(len(left_out), i))
                    smaller.append(np.full(len(left_out), n == a))
            if rows:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(tags)),
                    *(pa.array(np.concatenate(k).view(np.int64)) for k in keys),
                    doc.take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(smaller))],
                    names=["tag", "key_a", "key_b", "doc", "smaller"])

    return source.mapInArrow(run, "tag long, key_a long, key_b long, doc long, smaller boolean")


def boundary(signed: DataFrame, limit: Threshold) -> int:
    """The size up to which sets are light, of the least estimated cost."""
    top = MOST_LIGHT * 2
    counts = {r["n"]: r["c"] for r in signed.filter(F.col("n").between(1, top))
              .groupBy("n").agg(F.count("*").alias("c")).collect()}

    def cost(x: int) -> int:
        light = sum(c * sum(math.comb(n, o) for _, _, o in subset_tags(n, x, limit))
                    for n, c in counts.items() if n <= x)
        posted = sum(c * limit.prefix(n) for n, c in counts.items() if n >= _least_heavy(x, limit))
        return light + POSTING_COST * posted

    return min(range(MOST_LIGHT + 1), key=cost)


def _least_heavy(x: int, limit: Threshold) -> int:
    """The smallest set that can link with one above the boundary."""
    return -(-limit.num * (x + 1) // limit.den)


def light_links(keys: DataFrame) -> DataFrame:
    """Links of sets with a common subset to the smallest document of the smaller size."""
    group = ("tag", "key_a", "key_b")
    leaders = written(keys.groupBy(*group).agg(
        F.min(F.when(F.col("smaller"), F.col("doc"))).alias("b"), F.min("doc").alias("low"),
        F.max("doc").alias("high")).filter("b IS NOT NULL AND low < high").drop("low", "high"), "light-leaders")
    return keys.join(leaders, list(group)).select(F.col("doc").alias("a"), "b")


def _verified(meetings: DataFrame, limit: Threshold) -> DataFrame:
    """Links between the members and the guests of each table of sets.

    ``meetings``: (place, salt, node, host, guest, shingles). Links that connect nothing
    new within a task are left out.
    """
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        host, guest = (table.column(c).to_numpy().astype(bool) for c in ("host", "guest"))
        node = table.column("node").to_numpy()
        lists = table.column("shingles").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        first = lists.offsets.to_numpy()
        values = lists.values.to_numpy()
        size = np.diff(first)
        members = np.flatnonzero(host)
        owner = np.repeat(np.arange(len(members)), size[members])
        held = np.concatenate([values[first[i]:first[i + 1]] for i in members]) \
            if len(members) else np.zeros(0, np.int64)
        order = np.argsort(held, kind="stable")
        held, owner = held[order], owner[order]
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.get(x, x)) != x:
                root[x] = root.get(up, up)
                x = up
            return x

        found = []
        for i in np.flatnonzero(guest):
            own = values[first[i]:first[i + 1]]
            low, high = np.searchsorted(held, own, "left"), np.searchsorted(held, own, "right")
            n = high - low
            at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            shared = np.bincount(owner[at], minlength=len(members))
            linked = limit.links(shared, size[i], size[members]) & (shared > 0)
            for other in node[members[linked]].tolist():
                a, b = find(int(node[i])), find(other)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    found.append((int(node[i]), other))
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    columns = ("place", "salt", "node", "host", "guest", "shingles")
    return meetings.select(*columns).groupBy("place", "salt").applyInArrow(run, "a long, b long")


def _seats(members: DataFrame, guests: DataFrame) -> DataFrame:
    """(place, salt, node, host, guest): which sets meet, before any set is moved.

    A row for each member (place, node, n) at each table of its chunk, and for each
    guest at one. A chunk whose guests are too many for a task gets several tables.
    """
    tables = guests.groupBy("place").agg(F.ceil(F.sum("n") / F.lit(MEETING)).cast("int").alias("tables"))
    hosts = members.join(tables, "place").select(
        "place", F.explode(F.sequence(F.lit(0), F.col("tables") - 1)).alias("salt"), "node",
        F.lit(True).alias("host"), F.lit(False).alias("guest"))
    seated = guests.join(tables, "place").select(
        "place", F.pmod(F.xxhash64(F.lit(1), "node"), F.col("tables")).cast("int").alias("salt"), "node",
        F.lit(False).alias("host"), F.lit(True).alias("guest"))
    return written(hosts.unionByName(seated).groupBy("place", "salt", "node").agg(
        F.max("host").alias("host"), F.max("guest").alias("guest")), "join-seats")


def _seated(source: DataFrame, seats: DataFrame, length: int) -> DataFrame:
    """``seats`` with ``shingles``: sets are made from the texts where they are needed.

    Texts of documents without a seat, but for a few, are not moved.
    """
    per_node = seats.groupBy(F.col("node").alias("doc")).agg(
        F.collect_list(F.struct("place", "salt", "host", "guest")).alias("seats"))
    seats_type = per_node.schema["seats"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            doc, texts, lists = (batch.column(c) for c in ("doc", "t", "seats"))
            for a, b in shingles.slices(texts):
                values, first = sets_of(texts.slice(a, b - a), length)
                sets = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [doc.slice(a, b - a), lists.slice(a, b - a), sets], names=["node", "seats", "shingles"])

    some = likely(source, seats.select(F.col("node").alias("doc")), "doc")
    made = some.join(per_node, "doc").select("doc", "t", "seats").mapInArrow(
        run, f"node long, seats {seats_type}, shingles array<long>")
    return made.select("node", "shingles", F.explode("seats").alias("s")).select("node", "shingles", "s.*")


def _headed(entries: DataFrame, purpose: str) -> DataFrame:
    """Entries of lists with several nodes, with the smallest node of the list; replaces ``entries``."""
    heads = written(entries.groupBy("shingle").agg(F.min("node").alias("head"), F.max("node").alias("high"))
                    .filter("head < high").drop("high"), "join-heads")
    return written(entries.join(heads, "shingle"), purpose, entries, heads)


def heavy_links(source: DataFrame, signed: DataFrame, classes: DataFrame, length: int,
                limit: Threshold, least: int) -> DataFrame:
    """Links among sets that share an inverted list; enough to connect all that link."""
    spark = source.sparkSession
    common = spark.sparkContext.broadcast(frequent(source, length))
    # most lists hold one document: those go where the postings arrive, by one shuffle and one pass over the texts
    own = Window.partitionBy("shingle")
    posted = postings(source, length, limit, least, common).withColumns(
        {"low": F.min("doc").over(own), "high": F.max("doc").over(own)}).filter("low < high")
    # classes: (doc, node) of documents that are copies of a smaller one
    entries = written(
        posted.join(classes.withColumnRenamed("doc", "copy"), F.col("doc") == F.col("copy"), "left")
        .select("shingle", F.coalesce("node", "doc").alias("node"), "rank").distinct(), "join-entries")
    entries = _headed(entries, "join-shared")
    sizes = signed.groupBy(F.col("doc").alias("node")).agg(F.max("n").alias("n"), F.min("n").alias("low"))
    # documents that share a passage with others, but not enough, leave here
    possible = written(_possible(entries, sizes, limit), "join-possible")
    prefix = F.expr(f"n - ({limit.num} * n + {limit.den} - 1) div {limit.den} + 1")
    entries = written(entries.drop("head").join(possible, "node").filter(F.col("rank") < prefix)
                      .groupBy("shingle", "node").agg(F.max(F.expr(limit.reach())).alias("reach")), "join-prefixes", entries)
    entries = _headed(entries, "join-families")

    # a node's family is the smallest head of its lists; families are cut into chunks
    family = entries.groupBy("node").agg(F.min("head").alias("family")).join(possible, "node")
    chunks = family.groupBy("family").agg(F.ceil(F.sum("n") / F.lit(CHUNK)).cast("int").alias("chunks"))
    nodes = written(family.join(chunks, "family").select(
        "node", "n", "family", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk")),
        "join-nodes", possible)
    place = F.struct("family", "chunk")

    members = nodes.select(place.alias("place"), "node", "n")

    guests = nodes.select(F.struct("family", F.lit(0).alias("chunk")).alias("place"), "node", "n")
    seats = _seats(members.filter("place.chunk = 0"), guests)
    near = written(_verified(_seated(source, seats, length), limit), "join-near", seats)

    # lists that still hold several components: all but the largest meet the others, where
    # a list has sets of a size that can link. It is enough that two sets meet at their first
    # common shingle, where each is within the other's reach
    parts = components(near)
    found = parts.select(F.col("a").alias("node"), F.col("b").alias("part"))
    placed = written(entries.select("shingle", "node", "reach").join(nodes, "node").join(found, "node", "left").select(
        "shingle", "node", "n", "reach", place.alias("place"), F.coalesce("part", "node").alias("part")),
        "join-parts", entries, parts, nodes)
    per_part = placed.groupBy("shingle", "part").agg(F.count("*").alias("n"))
    largest = per_part.groupBy("shingle").agg(
        F.max_by("part", F.struct("n", "part")).alias("largest"), F.count("*").alias("parts")) \
        .filter("parts > 1").drop("parts")
    still = written(placed.join(largest, "shingle"), "join-still", placed)
    there = still.groupBy("shingle", "place").agg(
        F.min("part").alias("low"), F.max("part").alias("high"), F.min("n").alias("least"), F.max("n").alias("most"),
        F.max("reach").alias("far"))
    alike = f"(low <> part OR high <> part) AND {limit.den} * most >= {limit.num} * n AND least <= reach AND n <= far"
    asked = written(still.filter("part <> largest").select("shingle", "node", "n", "reach", "part").join(there, "shingle")
                    .filter(alike).select("shingle", "place", "node", "n", "reach", "part"), "join-asked")
    # of a place, only the sets of lists that guests of another component and a like size have come for
    came = asked.groupBy("shingle", "place").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("part").alias("low"), F.max("part").alias("high"),
        F.max("reach").alias("far"))
    hosts = still.select("shingle", "place", "node", "n", "reach", "part").join(came, ["shingle", "place"]) \
        .filter(alike).select("place", "node", "n").distinct()
    guests = asked.select("place", "node", "n").distinct()
    seats = _seats(hosts, guests)
    discard(still, asked)
    far = written(_verified(_seated(source, seats, length), limit), "join-far", seats)
    return near.unionByName(far)


def _linked(docs: DataFrame, id_col: str, text_col: str, length: int, percent: int) -> tuple:
    """(id, row, doc, n, ...) of each row, links between ``doc``, and whether ids repeat.

    ``doc`` is the id where no id repeats, else the row.
    """
    limit = Threshold(percent)
    source = _input(docs, id_col, text_col)
    signed = written(signatures(source, length), "join-signed")
    repeat = not signed.groupBy("id").agg(F.count("*").alias("c")).filter("c > 1").isEmpty()
    signed = signed.withColumn("doc", F.col("row" if repeat else "id"))
    source = source.select(F.col("row" if repeat else "id").alias("doc"), "t")
    full = signed.filter("n > 0")
    firsts = written(full.groupBy("set_a", "set_b").agg(F.min("doc").alias("node"), F.max("doc").alias("high"))
                     .filter("node < high").drop("high"), "join-classes")
    classes = written(full.join(firsts, ["set_a", "set_b"]).filter("doc > node")
                      .select("doc", "node").distinct(), "join-copies")
    most = boundary(signed, limit)
    links = classes.select(F.col("doc").alias("a"), F.col("node").alias("b"))
    if most:
        keys = written(subset_hashes(source, length, limit, most), "light-subsets")
        links = links.unionByName(light_links(keys))
    links = links.unionByName(heavy_links(source, signed, classes, length, limit, _least_heavy(most, limit)))
    return signed, links, repeat


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 5,
            percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id), a row per row of ``docs``."""
    signed, links, repeat = _linked(docs, id_col, text_col, length, percent)
    if repeat:  # rows with one id are one document
        first = signed.groupBy("id").agg(F.min("doc").alias("b"), F.max("doc").alias("high")).filter("b < high")
        links = links.unionByName(signed.join(first, "id").select(F.col("doc").alias("a"), "b"))
    roots = components(links).withColumnsRenamed({"a": "doc", "b": "root"})
    found = signed.join(roots, "doc", "left").withColumn("root", F.coalesce("root", "doc"))
    if repeat:
        found = written(found, "join-roots")
        found = found.join(found.groupBy("root").agg(F.min("id").alias("least")), "root").withColumn("root", F.col("least"))
    kind = docs.schema[id_col].dataType
    id_type = kind if isinstance(kind, T.NumericType) else T.LongType()
    last = F.lit(LAST_ID)

    def shown(c):
        return F.when(c != last, c).cast(id_type)

    return found.select(
        shown(F.col("id")).alias(id_col), F.col("n").alias("n_shingles"), shown(F.col("root")).alias("component_id"))


def first_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 5,
               percent: int = 80) -> DataFrame:
    """(_doc, _row, copies): the smallest row of each group of linked rows, by id and row key.

    Rows are linked by their texts only, whatever their ids. ``copies`` rows have this
    key; 1 for texts without shingles, which are nobody's copies.
    """
    signed, links, repeat = _linked(docs, id_col, text_col, length, percent)
    roots = components(links).withColumnsRenamed({"a": "doc", "b": "root"})
    found = signed.join(roots, "doc", "left").withColumn("root", F.coalesce("root", "doc"))
    if not repeat:
        return found.filter("root = doc").select(
            F.col("id").alias("_doc"), F.col("row").alias("_row"), F.lit(1).cast("long").alias("copies"))
    rows = found.groupBy("root", "id", "row").agg(
        F.when(F.max("n") > 0, F.count("*")).otherwise(F.lit(1).cast("long")).alias("copies"))
    return rows.groupBy("root").agg(F.min(F.struct("id", "row", "copies")).alias("r")).select(
        F.col("r.id").alias("_doc"), F.col("r.row").alias("_row"), F.col("r.copies").alias("copies"))
