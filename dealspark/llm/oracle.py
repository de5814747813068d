"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

RULE_LEDGER = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), windows AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, seen) AS n
  FROM (SELECT doc_id, pos, list_slice(w, pos, pos + 7) AS seen
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS pos FROM words WHERE len(w) >= 8))
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(pos, pos + 8)) AS p FROM windows WHERE n > 1) GROUP BY doc_id
), measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_lines, 0)::BIGINT AS n_lines,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1]))::BIGINT AS n_adjacent_words,
    length(regexp_replace(text, '[^A-Za-z]+', '', 'g'))::BIGINT AS n_letters,
    length(regexp_replace(text, '[^A-Z]+', '', 'g'))::BIGINT AS n_capitals, (strlen(text) - length(text))::BIGINT AS n_wide
  FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), judged AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 30 * n_words THEN 4 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN 100 * n_adjacent_words > 30 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 100 * n_capitals > 50 * n_letters THEN 32 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 40 * n_words THEN 64 ELSE 0 END
    + CASE WHEN 100 * n_capitals > 50 * n_letters AND 2 * n_wide <= word_chars THEN 128 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR (word_chars > 40 * n_words AND 2 * n_wide <= word_chars) THEN 256 ELSE 0 END)::BIGINT AS fail_bits
  FROM measured
), named AS (
  SELECT *, CASE fail_bits & 415 WHEN 1 THEN 'few_words' WHEN 2 THEN 'repeated_windows' WHEN 4 THEN 'symbols' WHEN 8 THEN 'duplicate_lines'
    WHEN 16 THEN 'adjacent_repeats' WHEN 128 THEN 'ascii_capitals' WHEN 256 THEN 'ascii_word_length' END AS only_rule
  FROM judged
)
SELECT *, (fail_bits & 3) <> 0 AS base_failed, (fail_bits & 415) = 0 AS kept, (fail_bits & 127) = 0 AS kept_clean_1,
  CASE WHEN only_rule IS NOT NULL THEN count(*) OVER (PARTITION BY only_rule) END AS given_back
FROM named
"""

WATER_FILLING = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS pos
  FROM documents
), by_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0)) / sum(weight) OVER onward AS level
  FROM by_source
  WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         onward AS (ORDER BY 2.0::DOUBLE * source_size / weight, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), goals AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, coalesce(weight *
    (SELECT max(level) FROM levels WHERE level <= 2.0::DOUBLE * source_size / weight), 2.0::DOUBLE * source_size)) AS target
  FROM by_source
), shares AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM goals
), ordered AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.whole, round(g.target)::BIGINT - g.whole * g.source_size AS rest,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.pos, s.doc_id NULLS LAST, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN shares g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target, whole, greatest(0, least(size, rest - before))::BIGINT AS extra,
  (whole * size + greatest(0, least(size, rest - before)))::BIGINT AS taken
FROM ordered
"""

EXTENDIBLE_HASH = r"""
WITH normalised AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm, length(coalesce(text, '')) AS points
  FROM documents
), ranked AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
    first_value(doc_id) OVER best AS keep_id, row_number() OVER best AS pos
  FROM normalised WINDOW best AS (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, pos = 1 AS kept, sha256(norm) AS text_sha256 FROM ranked
"""

WARC_TRANSACTIONS = r"""
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages
), digested AS (
  SELECT *, min(page_id) OVER (PARTITION BY sha) AS first_id,
    list_reduce([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(sha, 1 + 5 * (d // 4), 5))::BIGINT >> (15 - 5 * (d % 4))) & 31)::INT + 1, 1)
      FOR d IN range(32)], lambda x, y: x || y) AS payload_digest
  FROM hashed
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM digested
"""

PREFIX_TRIE = r"""
WITH turns AS (
  SELECT conv_id AS conv, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, strlen(text), sha256(strlen(role) || ':' || role || text)) AS t
  FROM turns GROUP BY conv
), heads AS (
  SELECT conv, t, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv::VARCHAR, ''), lambda c: ord(c)::BIGINT),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
    4294967295) % 9 AS h
  FROM convs
), rebuilt AS (
  SELECT c.conv, list_concat(coalesce(list_slice(b.t, 1, c.h), []), list_slice(c.t, c.h + 1, len(c.t))) AS t
  FROM heads c LEFT JOIN convs b ON b.conv = c.conv - c.conv % 5
), prefixes AS (
  SELECT conv, d, list_slice(t, 1, d) AS p, len(t) AS n FROM (SELECT conv, t, unnest(range(0, len(t) + 1)) AS d FROM rebuilt)
), members AS (
  SELECT d, p, min(conv) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv::VARCHAR, ',' ORDER BY conv) FILTER (n = d), '')) AS ends_sha256,
    CASE WHEN d > 0 THEN strlen(p[d].text) ELSE 0 END AS bytes
  FROM prefixes GROUP BY d, p
), children AS (
  SELECT d - 1 AS d, list_slice(p, 1, d - 1) AS p, count(*) AS n_children FROM members WHERE d > 0 GROUP BY 1, 2
), nodes AS (
  SELECT m.*, coalesce(c.n_children, 0) AS n_children FROM members m LEFT JOIN children c ON c.d = m.d AND c.p = m.p
), subtrees AS (
  SELECT k, list_slice(p, 1, k) AS p, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * bytes) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM nodes) GROUP BY 1, 2
)
SELECT m.conv_id, m.d::BIGINT AS depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, m.ends_sha256
FROM nodes m JOIN subtrees s ON s.k = m.d AND s.p = m.p LEFT JOIN members u ON u.d = m.d - 1 AND u.p = list_slice(m.p, 1, m.d - 1)
"""


JACCARD_JOIN = r"""
WITH RECURSIVE worded AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS MATERIALIZED (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 3 THEN [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s
  FROM worded
), classes AS MATERIALIZED (
  SELECT s, row_number() OVER () AS c, len(s) AS n, first_id FROM (SELECT s, min(doc_id) AS first_id FROM sets WHERE len(s) > 0 GROUP BY s)
), shingles AS MATERIALIZED (
  SELECT c, n, unnest(s) AS g FROM classes
), links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.c AS a, y.c AS b, any_value(x.n + y.n) AS total, count(*) AS common FROM shingles x JOIN shingles y ON x.g = y.g
    AND x.c < y.c AND 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n) GROUP BY 1, 2)
  WHERE 100 * common >= 90 * (total - common)
), reach(c, r) AS (
  SELECT c, c FROM classes
  UNION
  SELECT reach.c, e.b FROM reach JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) e ON e.a = reach.r
), components AS (
  SELECT reach.c, min(t.first_id) AS component_id FROM reach JOIN classes t ON t.c = reach.r GROUP BY reach.c
)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, CASE WHEN len(d.s) = 0 THEN d.doc_id ELSE m.component_id END AS component_id
FROM sets d LEFT JOIN classes k ON k.s = d.s LEFT JOIN components m ON m.c = k.c
"""


def vector_codes(rounds: int = 4) -> str:
    """Four parts of 16 components, 256 entries; every round written out."""
    def nearest(books: str) -> str:
        return f"""(
  SELECT v.rid, v.p, min((list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, b.y) + list_inner_product(b.y, b.y))::HUGEINT * 256 + b.e) AS best
  FROM parts v JOIN {books} b ON v.p = b.p GROUP BY v.rid, v.p)"""
    steps = ""
    for k in range(1, rounds + 1):
        steps += f""", near{k} AS MATERIALIZED {nearest(f'books{k - 1}')}, moved{k} AS (
  SELECT p, e, list(m ORDER BY i) AS y FROM (
    SELECT n.p, (n.best % 256)::BIGINT AS e, u.i, floor(sum(v.x[u.i]) / count(*)) AS m
    FROM near{k} n JOIN parts v ON v.rid = n.rid AND v.p = n.p CROSS JOIN range(1, 17) u(i) GROUP BY 1, 2, 3) GROUP BY p, e
), books{k} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.y, b.y) AS y FROM books{k - 1} b LEFT JOIN moved{k} m ON m.p = b.p AND m.e = b.e
)"""
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT rid, p, list_slice(q, 16 * p + 1, 16 * p + 16) AS x FROM kept CROSS JOIN range(4) r(p)
), firsts AS (
  SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, q) - 1 AS e FROM kept QUALIFY e < 256
), books0 AS MATERIALIZED (
  SELECT v.p, f.e, v.x AS y FROM firsts f JOIN parts v USING (rid)
){steps}, final AS MATERIALIZED {nearest(f'books{rounds}')}, coded AS (
  SELECT rid, string_agg(printf('%02x', (best % 256)::INT), '' ORDER BY p) AS code, sum(best // 256)::BIGINT AS error FROM final GROUP BY rid
), digest AS (
  SELECT sha256(string_agg(array_to_string(list_transform(y, lambda v: v::BIGINT::VARCHAR), ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM books{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (rid) CROSS JOIN digest
"""


ORACLE = {
    "op6_warc_transactions": WARC_TRANSACTIONS,
    "op3_rule_ledger": RULE_LEDGER,
    "op4_water_filling": WATER_FILLING,
    "op8_extendible_hash": EXTENDIBLE_HASH,
    "op11_memoised_cells": vector_codes(),
    "op12_turn_rollup": PREFIX_TRIE,
    "op13_banded_tiles": JACCARD_JOIN,
}
