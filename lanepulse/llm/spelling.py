"""Groups of spelling variants by a relational trie frontier.

The words, and the words reversed, form two tries. Nodes are hashes of prefixes; a table
of edges holds, for each node that branches or ends a word, what follows up to the next
such node. A state is (word, candidate, place in it, node): an edit that is possible at a
branching node leads to a state with one edit, and states then move level by level
through the edge table as long as the candidate's letters are there. A state that ends
where a word ends is a pair of neighbours, compared once more as texts. The forward trie
takes edits in the second half of a word, the reversed one edits in the first half, so no
state starts at the crowded nodes near the root. An edit in a run of equal letters is
taken at the run's end.

Null and empty texts have no words, a null id reads as an empty one. Counts are over all
rows, repeated ones included. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanepulse.llm.common import lower_ascii, written

#: Letters of a word: A-Z, a-z and Latin-1 from U+00C0 on.
LETTERS = "[A-Za-zÀ-ÿ]+"
#: Words up to this length are their own keys; others are known by a hash while they move.
_KEY = 64


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 6,
                least: int = 5, slip: int | None = None) -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, with at least ``least`` occurrences.

    ``slip``: where it divides the CRC-32 h of ``<id>:<run>``, the run loses its letter
    number h modulo its length, from 0.
    """
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"),
        F.explode(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(LETTERS), F.lit(0))).alias("r"))
    runs = runs.filter(F.length("r") >= shortest).select("i", lower_ascii(F.col("r")).alias("r"))
    if slip is not None:
        h = F.crc32(F.encode(F.concat("i", F.lit(":"), "r"), "UTF-8"))
        runs = runs.select("r", h.alias("h")).select(F.when(F.col("h") % slip == 0, F.expr(
            "concat(substring(r, 1, int(h % length(r))), substring(r, int(h % length(r)) + 2))"))
            .otherwise(F.col("r")).alias("r")).filter(F.length("r") >= shortest)
    return runs.groupBy(F.col("r").alias("word")).agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _node(prefix: str) -> str:
    return f"xxhash64(d, {prefix})"


def _prefixes(keyed: DataFrame) -> DataFrame:
    """(d, key, i, node, next): the prefixes of both directions, from before the middle on.

    ``next`` is the letter behind the prefix, empty at the end of the word.
    """
    both = keyed.select("key", F.explode(F.array(
        F.struct(F.lit(0).alias("d"), F.col("word").alias("s")),
        F.struct(F.lit(1).alias("d"), F.reverse("word").alias("s")))).alias("e")).select("key", "e.*")
    places = F.expr(f"""transform(sequence(greatest(length(s) div 2 - 1, 0), length(s)), i -> struct(
        int(i) AS i, {_node("substring(s, 1, int(i))")} AS node, substring(s, int(i) + 1, 1) AS next))""")
    return both.select("d", "key", F.explode(places).alias("p")).select("d", "key", "p.*")


def _nodes(prefixes: DataFrame) -> DataFrame:
    """(node, ends, after): nodes that branch or end a word, with the letters behind them."""
    seen = prefixes.groupBy("node", "next").agg(F.lit(1).alias("one"))
    return seen.groupBy("node").agg(
        F.max(F.col("next") == "").alias("ends"),
        F.array_join(F.array_sort(F.collect_list("next")), "").alias("after")).filter("ends OR length(after) > 1")


def _edges(paths: DataFrame) -> DataFrame:
    """(node, letter, label, to, to_ends, to_after): the way to the next node, by its first letter.

    A node that ends a word has an empty edge to itself as well.
    """
    steps = paths.groupBy("d", "word").agg(F.array_sort(F.collect_list(
        F.struct("i", "node", "ends", "after"))).alias("p"))
    pairs = F.expr("""transform(slice(p, 2, size(p)), (q, k) -> struct(
        p[k].node AS node, substring(s, p[k].i + 1, q.i - p[k].i) AS label, q.node AS to, q.ends AS to_ends,
        q.after AS to_after))""")
    way = steps.withColumn("s", _directed("word")).select(F.explode(pairs).alias("e")).select("e.*")
    way = way.groupBy("node", F.substring("label", 1, 1).alias("letter"), "label", "to").agg(
        F.max("to_ends").alias("to_ends"), F.max("to_after").alias("to_after"))
    ends = paths.filter("ends").groupBy("node").agg(F.max("after").alias("to_after")).select(
        "node", F.lit("").alias("letter"), F.lit("").alias("label"), F.col("node").alias("to"),
        F.lit(True).alias("to_ends"), "to_after")
    return way.unionByName(ends)


def _directed(word: str) -> Column:
    """The word as its trie reads it; and back."""
    return F.expr(f"if(d = 1, reverse({word}), {word})")


def _moved(joined: DataFrame) -> DataFrame:
    """States behind an edge, if the candidate's letters go on there."""
    there = joined.filter("startswith(rest, label)").withColumn("rest", F.expr("substring(rest, length(label) + 1)"))
    return there.filter("if(rest = '', to_ends, instr(to_after, substring(rest, 1, 1)) > 0)").select(
        "d", "word", "candidate", "rest", F.col("to").alias("node"))


def neighbours(words: DataFrame) -> DataFrame:
    """(word, other): pairs of different words, one inserted, deleted or replaced letter apart; both ways.

    ``words``: a column ``word`` of distinct words.
    """
    key = F.when(F.length("word") <= _KEY, F.col("word")).otherwise(F.concat(F.lit("\n"), F.sha2("word", 256)))
    keyed = words.filter("word IS NOT NULL").select(key.alias("key"), "word")
    prefixes = written(_prefixes(keyed), "spelling-prefixes")
    nodes = written(_nodes(prefixes), "spelling-nodes")
    long = keyed.filter(F.length("word") > _KEY)
    paths = prefixes.join(nodes, "node").join(long, "key", "left") \
        .select("d", F.coalesce("word", "key").alias("word"), "i", "next", "node", "ends", "after")
    paths = written(paths, "spelling-paths")
    edges = written(_edges(paths), "spelling-edges")

    # edits: from a node on the word's own way along an edge that the word does not take
    here = paths.withColumn("s", _directed("word")).filter(
        "i >= if(d = 0, length(s) div 2, length(s) - length(s) div 2)")
    tail = "substring(s, i + {}, length(s))"
    edits = F.expr(f"""explode(array(
        if(letter <> '' AND next <> '', concat(letter, {tail.format(2)}), null),
        if(letter <> '', concat(letter, {tail.format(1)}), null),
        if(next <> '' AND letter = substring(s, i + 2, 1), {tail.format(2)}, null)))""")
    first = here.join(edges, "node").filter("letter <> next").select(
        "d", "word", "s", "i", "label", "to", "to_ends", "to_after", edits.alias("rest")).filter("rest IS NOT NULL")
    states = _moved(first.withColumn("candidate", F.expr("concat(substring(s, 1, i), rest)")))
    found = None
    while True:
        states = written(states, "spelling-states")
        ended = states.filter("rest = ''").select("word", _directed("candidate").alias("other"))
        found = ended if found is None else found.unionByName(ended)
        states = states.filter("rest <> ''")
        if states.isEmpty():
            break
        states = _moved(states.withColumn("letter", F.substring("rest", 1, 1)).join(edges, ["node", "letter"]))
    # nodes are known by hashes; the words themselves decide
    return found.distinct().join(words.select(F.col("word").alias("other")), "other").select("word", "other")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the end of each chain of forms, by doubling the steps."""
    ways = written(forms.select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("end"))
        longer = written(ways.join(further, "root", "left").select("word", "root", "end"), "spelling-roots")
        if longer.filter("end IS NOT NULL").isEmpty():
            return ways
        ways = longer.select("word", F.coalesce("end", "root").alias("root"))


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n).

    ``form`` is the most frequent neighbour (of equal ones the first in code-point order) if
    it is at least ``ratio`` times as frequent as the word; ``root`` the end of the forms.
    """
    words = written(words, "spelling-words")
    counts = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    near = neighbours(words).join(counts, "other").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("top"))
    known = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("top.other").alias("form"),
        (-F.col("top.less")).alias("form_n")), "spelling-near")
    known = known.withColumn("far", F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False))).withColumns({
        c: F.when(F.col("far"), F.col(c)) for c in ("form", "form_n")})
    roots = _roots(known.filter("far").select("word", "form"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
