"""The operators' results as DuckDB SQL over the whole tables, where SQL can express them."""

from __future__ import annotations

#: White space as the word and line rules have it.
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"'[^\x20\x09-\x0D]+'"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


def _words(text: str) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), {_WORD})"


LINE_DEDUP = f"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (
    SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM split),
keyed AS (
    SELECT *, {_lower(f"trim(line, {_SPACES})")} AS key FROM lines),
held AS (
    SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (
    SELECT k.*, coalesce(k.doc_id > h.first, false) AS dropped FROM keyed k LEFT JOIN held h USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""

JACCARD_JOIN = f"""
WITH RECURSIVE split AS (
    SELECT doc_id, {_words(_lower("text"))} AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
        THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM split),
sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
-- equal sets stand for each other, so that groups of copies are not listed pair by pair
sets AS (
    SELECT doc_id, md5(string_agg(s, chr(10) ORDER BY s)) AS set_md5 FROM shingles GROUP BY doc_id),
classes AS (
    SELECT doc_id, min(doc_id) OVER (PARTITION BY set_md5) AS node FROM sets),
own AS (
    SELECT s.doc_id, s.s FROM shingles s JOIN classes c USING (doc_id) WHERE c.node = c.doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM own a JOIN own b ON a.s = b.s AND a.doc_id < b.doc_id
    GROUP BY 1, 2),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)),
both_ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (
    SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b),
least AS (
    SELECT a AS node, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, least(c.node, l.low, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes z USING (doc_id) LEFT JOIN classes c USING (doc_id) LEFT JOIN least l USING (node)"""

QUALITY_RULES = f"""
WITH split AS (
    SELECT doc_id, {_words("text")} AS w, coalesce(text, '') AS t FROM documents),
windows AS (
    SELECT doc_id, pos, w[pos:pos + 2] AS three
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS pos FROM split)),
repeated AS (
    SELECT doc_id, pos FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, three) > 1),
covered AS (
    SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS place FROM repeated)
    GROUP BY doc_id),
lines AS (
    SELECT doc_id, count(*) AS n, count(DISTINCT line) AS once
    FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM split)
    WHERE trim(line, {_SPACES}) <> '' GROUP BY doc_id),
measured AS (
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
        coalesce(l.n, 0) AS n_full_lines, coalesce(l.n - l.once, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
        length(regexp_replace(t, '[^\\p{{L}}]', '', 'g')) AS n_letters,
        length(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g')) AS n_capitals
    FROM split LEFT JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id)),
judged AS (
    SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
        + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
        + (CASE WHEN 10 * n_symbols > word_chars THEN 4 ELSE 0 END)
        + (CASE WHEN 10 * n_dup_lines > 3 * n_full_lines THEN 8 ELSE 0 END)
        + (CASE WHEN word_chars < 2 * n_words OR word_chars > 25 * n_words THEN 16 ELSE 0 END)
        + (CASE WHEN 2 * n_letters < word_chars THEN 32 ELSE 0 END)
        + (CASE WHEN 2 * n_capitals > n_letters THEN 64 ELSE 0 END) AS failures FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures & 3 <> 0 AS base_failed,
    failures = 0 AS kept, n_letters, n_capitals, n_full_lines, failures::BIGINT AS failures FROM judged"""

SUBSTRING_DEDUP = f"""
WITH split AS (
    SELECT doc_id, {_words("text")} AS w FROM documents),
places AS (
    SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS pos FROM split),
windows AS (
    SELECT doc_id, pos, w[pos] AS word,
        CASE WHEN pos + 49 <= len(w) THEN md5(array_to_string(w[pos:pos + 49], ' ')) END AS fifty FROM places),
firsts AS (
    SELECT fifty, min(doc_id) AS first FROM windows WHERE fifty IS NOT NULL GROUP BY fifty),
judged AS (
    SELECT x.doc_id, x.pos, x.word, coalesce(max(CASE WHEN f.first < x.doc_id THEN x.pos END) OVER (
        PARTITION BY x.doc_id ORDER BY x.pos) > x.pos - 50, false) AS removed
    FROM windows x LEFT JOIN firsts f USING (fifty)),
kept AS (
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE removed) AS n_removed,
        string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT removed) AS text FROM judged GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)"""

SPELLING = f"""
WITH RECURSIVE crc AS (
    SELECT list(x ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS x
        FROM (SELECT unnest(range(256))::BIGINT AS i))),
runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS d, {_lower("r")} AS r, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS r FROM documents)
    WHERE length(r) >= 6 GROUP BY ALL),
bytes AS (
    -- letters are ASCII or take two bytes
    SELECT r, n, flatten(list_transform(string_split(d || ':' || r, ''), lambda c: CASE WHEN unicode(c) < 128
        THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c)::BIGINT >> 6), 128 + (unicode(c)::BIGINT & 63)] END)) AS b FROM runs),
hashed AS (
    SELECT r, n, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295), 4294967295) AS h
    FROM bytes, crc),
words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 199 = 0
        THEN substr(r, 1, (h % length(r))::INT) || substr(r, (h % length(r))::INT + 2) ELSE r END AS word FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
places AS (
    SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
less AS (
    SELECT DISTINCT word, substr(word, 1, i - 1) || substr(word, i + 1) AS v FROM places),
holes AS (
    SELECT word, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS v FROM places),
near AS (
    SELECT l.word, w.word AS other FROM less l JOIN words w ON w.word = l.v
    UNION SELECT w.word, l.word FROM less l JOIN words w ON w.word = l.v
    UNION SELECT a.word, b.word FROM holes a JOIN holes b ON a.v = b.v AND a.word <> b.word),
best AS (
    SELECT near.word, count(*) AS n_near, arg_min(near.other, (-w.n, encode(near.other))) AS other, max(w.n) AS other_n
    FROM near JOIN words w ON w.word = near.other GROUP BY near.word),
forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * n THEN other END AS form,
        CASE WHEN other_n >= 5 * n THEN other_n END AS form_n FROM words LEFT JOIN best USING (word)),
chain(word, last) AS (
    SELECT word, word FROM words UNION ALL
    SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.last WHERE f.form IS NOT NULL),
roots AS (
    SELECT c.word, c.last FROM chain c JOIN forms f ON f.word = c.last WHERE f.form IS NULL)
SELECT f.word, f.form, r.last AS root, f.n, f.n_near, f.form_n FROM forms f JOIN roots r USING (word)"""

HARD_NEGATIVES = """
WITH usable AS (
    SELECT vec_id, label::BIGINT AS label, embedding::DOUBLE[] AS x FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(x, lambda v: floor(256 * v)) AS q FROM usable),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
    FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negatives AS (
    SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
        AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 10"""

SQL = {
    "op3_line_dedup": LINE_DEDUP,
    "op4_ngram_jaccard_join": JACCARD_JOIN,
    "op5_quality_rules": QUALITY_RULES,
    "op6_substring_dedup": SUBSTRING_DEDUP,
    "op11_spelling_variants": SPELLING,
    "op12_hard_negatives": HARD_NEGATIVES,
}
