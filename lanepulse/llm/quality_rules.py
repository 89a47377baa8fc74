"""Quality rules as a ledger: measure once, one failure bit per rule.

``ledger`` evaluates every rule once and stores measurements and a bitmask. A
policy is a mask of the rules that reject; ``apply_policy`` is one bitwise AND,
and ``ablation`` answers, from counts per distinct bitmask, how many documents
each policy keeps, and how many more it would keep without each of its rules.
Only DataFrame functions are used; no row leaves its partition before the
ablation, which groups by bitmask (at most 2^rules groups).

Null and empty texts have no words and fail ``too_few_words``. Repeated rows are
judged alike. Measurement names replace columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanepulse.llm.common import SPACE, let, words

SYMBOLS = "#*$%&|<>"
#: A position takes the low bits of a packed window; no text has 2^30 words.
_POSITION_BITS = 30


@dataclass(frozen=True)
class Rule:
    """A rule's bit is its place in the list of rules, for ever: append only."""

    name: str
    fails: str


#: Conditions on the measurements, in SQL.
RULES = (
    Rule("too_few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > word_chars"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_full_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 25 * n_words"),
    Rule("few_letters", "2 * n_letters < word_chars"),
    Rule("shouting", "2 * n_capitals > n_letters"),
)
MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_full_lines", "n_dup_lines",
                "n_repeat_words", "n_letters", "n_capitals")
BASE = ("too_few_words", "repeated_words")
#: Versions stay as they are; a change of mind is a new version.
POLICIES = {
    "v1": BASE,
    "v2": tuple(rule.name for rule in RULES),
}


def mask(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    bits = {rule.name: 1 << i for i, rule in enumerate(rules)}
    return sum(bits[name] for name in names)


def _windows(word_list: Column) -> Column:
    """Per 3-word window: its hash in the high bits, its position in the low ones."""
    def packed(position: Column) -> Column:
        at = position.cast("int")
        digest = F.xxhash64(*(F.get(word_list, at + k) for k in range(3)))
        return F.shiftleft(digest, _POSITION_BITS).bitwiseOR(position)

    last = F.size(word_list) - 3
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0).cast("long"), last.cast("long")), packed)) \
        .otherwise(F.array().cast("array<bigint>"))


def repeated_words(word_list: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the list.

    Windows are sorted by a hash, with their positions packed behind it; those
    next to an equal hash are compared by their words. So the cost is that of
    sorting, and the count is exact.
    """
    position = (1 << _POSITION_BITS) - 1

    def beside_equal(items: Column, same) -> Column:
        """Items of a sorted array that equal the next one or the one before."""
        return F.filter(items, lambda x, i: same(x, F.get(items, i + 1)) | same(x, F.get(items, i - 1)))

    def same_hash(a: Column, b: Column) -> Column:
        return F.shiftrightunsigned(a.bitwiseXOR(b), _POSITION_BITS) == 0

    def spelled(packed: Column) -> Column:
        at = packed.bitwiseAND(F.lit(position)).cast("int")
        return F.struct(*(F.get(word_list, at + k).alias(f"w{k}") for k in range(3)), at.alias("at"))

    def same_words(a: Column, b: Column) -> Column:
        return (a["w0"] == b["w0"]) & (a["w1"] == b["w1"]) & (a["w2"] == b["w2"])

    def covered(starts: Column) -> Column:
        # each start covers three words, less what the next start covers itself
        return F.aggregate(
            F.transform(starts, lambda s, i: F.least(
                F.lit(3), F.coalesce(F.get(starts, i + 1) - s, F.lit(3)))),
            F.lit(0).cast("long"), lambda acc, n: acc + n)

    def exact(found: Column) -> Column:
        return let(F.sort_array(F.transform(found, spelled)), lambda spelt: let(F.sort_array(
            F.transform(beside_equal(spelt, same_words), lambda x: x["at"])), covered))

    return let(F.sort_array(_windows(word_list)), lambda packed: let(
        beside_equal(packed, same_hash),
        lambda found: F.when(F.size(found) == 0, F.lit(0).cast("long")).otherwise(exact(found))))


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the measurements as long columns."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    full_lines = F.filter(
        F.split(text, "\n", -1), lambda line: F.length(F.trim(line, F.lit(SPACE))) > 0)
    by_word = let(words(text), lambda w: F.struct(
        F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"),
        repeated_words(w).alias("n_repeat_words")))
    by_line = let(full_lines, lambda x: F.struct(
        F.size(x).alias("n_full_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    # what is left without white space and all letters but capitals is short
    signs = let(F.regexp_replace(text, r"[\p{L} \t-\r&&[^\p{Lu}]]+", ""), lambda x: F.struct(
        F.length(F.regexp_replace(x, r"\p{Lu}+", "")).alias("no_letters"), F.length(x).alias("n"),
        (F.length(x) - F.length(F.translate(x, SYMBOLS, ""))).alias("n_symbols")))
    # exploding one value computes it once; stacked projections would repeat it per use
    measured = docs.drop(*MEASUREMENTS).withColumn("_m", F.explode(F.array(F.struct(
        by_word.alias("w"), by_line.alias("l"), signs.alias("s")))))
    return measured.withColumns({
        "n_words": F.col("_m.w.n_words").cast("long"),
        "word_chars": F.col("_m.w.word_chars").cast("long"),
        "n_symbols": F.col("_m.s.n_symbols").cast("long"),
        "n_full_lines": F.col("_m.l.n_full_lines").cast("long"),
        "n_dup_lines": F.col("_m.l.n_dup_lines").cast("long"),
        "n_repeat_words": F.col("_m.w.n_repeat_words").cast("long"),
        "n_letters": (F.col("_m.w.word_chars") - F.col("_m.s.no_letters")).cast("long"),
        "n_capitals": (F.col("_m.s.n") - F.col("_m.s.no_letters")).cast("long"),
    }).drop("_m")


def ledger(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with measurements and ``failures``, the bitmask of failed rules."""
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(0).cast("long"))
    return measure(docs, text_col).withColumn("failures", bits)


def passes(policy: str, policies: dict = POLICIES, rules: tuple[Rule, ...] = RULES) -> Column:
    return F.col("failures").bitwiseAND(F.lit(mask(policies[policy], rules))) == 0


def apply_policy(entries: DataFrame, policy: str, **kwargs) -> DataFrame:
    """The entries of a ledger that ``policy`` keeps."""
    return entries.filter(passes(policy, **kwargs))


def ablation(entries: DataFrame, policies: dict = POLICIES,
             rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per policy and rule left out (null: none): documents kept, and the gain."""
    per_mask = entries.groupBy("failures").agg(F.count("*").alias("n"))
    trials = [
        (version, left_out, mask(names, rules) & ~(mask((left_out,), rules) if left_out else 0),
         mask(names, rules))
        for version, names in policies.items() for left_out in (None, *names)
    ]
    wide = per_mask.withColumn("t", F.explode(F.array(*(
        F.struct(F.lit(p).alias("policy"), F.lit(r).cast("string").alias("left_out"),
                 F.lit(m).cast("long").alias("mask"), F.lit(f).cast("long").alias("full_mask"))
        for p, r, m, f in trials))))
    kept = F.when(F.col("failures").bitwiseAND(F.col("t.mask")) == 0, F.col("n")).otherwise(0)
    full = F.when(F.col("failures").bitwiseAND(F.col("t.full_mask")) == 0, F.col("n")).otherwise(0)
    return wide.groupBy("t.policy", "t.left_out").agg(
        F.sum(kept).alias("kept"), (F.sum(kept) - F.sum(full)).alias("gain"))
