"""The operators' queries on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lanepulse.llm import (
    decontamination, fingerprints, hard_negatives, jaccard_join, language_id, line_dedup, mixing, oracle, quality_rules,
    spelling, substring_dedup, token_counts, toxicity, url_rules,
)
from lanepulse.llm.common import held_out, sha256, table, tokenizer

TOKEN_LIMIT = 2048
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
             ("allow", "org/fr/"))


def op5_quality_rules(spark, d):
    """Measurements, base verdict and the verdict of the newest policy."""
    entries = quality_rules.ledger(table(spark, d, "documents"))
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes("v1")).alias("base_failed"),
        quality_rules.passes("v2").alias("kept"),
        "n_letters", "n_capitals", "n_full_lines", "failures")


def op1_benchmark_decontamination(spark, d):
    """The benchmark items that leaked into each document."""
    return decontamination.leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op2_language_id(spark, d):
    """Language of every text, learned from the rows that are not held out."""
    docs = table(spark, d, "documents")
    held = held_out(F.col("doc_id")).alias("held_out")
    path = tokenizer("piece_bpe_32k.model")
    model = language_id.fit(docs.filter(~held), path)
    return language_id.predict(docs.select("doc_id", held, "text"), model).drop("text")


def op3_line_dedup(spark, d):
    """What line dedup leaves of every document."""
    left = line_dedup.dedup_lines(table(spark, d, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", sha256(F.col("kept_text")).alias("kept_sha256"))


def op4_ngram_jaccard_join(spark, d):
    """Each document's set size and the smallest document it reaches by links."""
    return jaccard_join.similar(table(spark, d, "documents"))


def op6_substring_dedup(spark, d):
    """What remains of every document without passages of earlier ones."""
    left = substring_dedup.remove_repeats(table(spark, d, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", sha256(F.col("kept_text")).alias("kept_sha256"))


def op7_token_counts(spark, d):
    """Exact token counts, the longest prefix within the limit, a digest of all prefixes' counts."""
    docs = table(spark, d, "documents").select(
        "doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    counted = token_counts.count_tokens(
        docs, tokenizer("word_bpe_49k.json"), limit=TOKEN_LIMIT, digest=True)
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "cut_chars",
        "prefix_sha256")


def op8_toxicity(spark, d):
    """Toxicity of every text, learned from labels of rows that are not held out."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    grammar = toxicity.fit(docs, labels.filter(~held_out(F.col("doc_id"))))
    held = held_out(F.col("doc_id")).alias("held_out")
    return toxicity.score(docs.select("doc_id", held, "text"), grammar).drop("text")


def op9_url_filters(spark, d):
    """Verdict per page: by the given rules, else by rules mined from what they judge."""
    return url_rules.judge(table(spark, d, "pages"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op10_mixing(spark, d):
    """Words taken of each document for the target mix."""
    return mixing.mix(table(spark, d, "documents"))


def op11_spelling_variants(spark, d):
    """Words of the corpus, some with a slip, and the frequent neighbours they may be slips of."""
    return spelling.variants(spelling.word_counts(table(spark, d, "documents"), slip=199))


def op12_hard_negatives(spark, d):
    """Rows of another label that score nearly as well as an anchor's positives."""
    rows = table(spark, d, "embeddings").filter(hard_negatives.usable(F.col("embedding")))
    label = F.col("label").cast("long")
    return hard_negatives.mine(rows.select(
        F.col("vec_id").cast("long").alias("id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        hard_negatives.quantized(F.col("embedding")).alias("vector")))


def op13_fingerprints(spark, d):
    """Fingerprints of every text and of its edited text, and how like they are."""
    return fingerprints.fingerprints(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_benchmark_decontamination, op2_language_id, op3_line_dedup, op4_ngram_jaccard_join, op5_quality_rules, op6_substring_dedup, op7_token_counts, op8_toxicity,
    op9_url_filters, op10_mixing, op11_spelling_variants, op12_hard_negatives, op13_fingerprints,
)}
#: For the driver's DuckDB check; queries that SQL cannot express have none.
ORACLE_SQL: dict[str, str] = oracle.SQL
