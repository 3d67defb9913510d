"""SQL that gives the rows of the corpus queries which SQL can express."""

from __future__ import annotations

from hourgrid.llm.quality_rules import MARKED, SEPARATOR, STOCK, STOPPED, Rules

EXACT_DEDUP = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

LINE_DEDUP = """
WITH numbered AS (
    SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents
), split AS (
    SELECT r, doc_id, string_split(text, chr(10)) AS parts FROM numbered
), lines AS (
    SELECT r, doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS i FROM split
), keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), repeated AS (
    SELECT key, max(doc_id) AS keep_id
    FROM keyed
    WHERE length(key) >= 40
    GROUP BY key
    HAVING count(DISTINCT doc_id) >= 5
), judged AS (
    SELECT k.r, k.doc_id, k.line, k.i, p.key IS NOT NULL AND k.doc_id <> p.keep_id AS dropped
    FROM keyed k LEFT JOIN repeated p ON p.key = k.key
)
SELECT any_value(doc_id) AS doc_id,
       count(*) AS n_lines,
       count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), ''))
           AS kept_sha256
FROM judged
GROUP BY r
"""

_R = Rules()
QUALITY_RULES = f"""
WITH numbered AS (
    SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents
), tokens AS (
    SELECT r, unnest(words) AS word, unnest(range(len(words))) AS i
    FROM (SELECT r, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM numbered)
), windows AS (
    SELECT r, i, word, lead(word, 1) OVER w AS second, lead(word, 2) OVER w AS third
    FROM tokens WINDOW w AS (PARTITION BY r ORDER BY i)
), repeated AS (
    SELECT r, i FROM windows WHERE third IS NOT NULL
    QUALIFY count(*) OVER (PARTITION BY r, word, second, third) > 1
), covered AS (
    SELECT r, count(*) AS n_repeat_words
    FROM (SELECT DISTINCT r, i + k AS i FROM repeated, (VALUES (0), (1), (2)) AS step (k))
    GROUP BY r
), lines AS (
    SELECT r, unnest(parts) AS line, unnest(range(len(parts))) AS i
    FROM (SELECT r, string_split(text, chr(10)) AS parts FROM numbered)
), worded AS (
    SELECT *, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS words,
           row_number() OVER (PARTITION BY r, line ORDER BY i) > 1 AS again
    FROM lines
), measured AS (
    SELECT r, again, len(words) AS n,
           length(array_to_string(words, '')) AS chars,
           len(list_filter(words, lambda x: regexp_matches(x, '{SEPARATOR}'))) AS separators,
           len(list_filter(words, lambda x: regexp_matches(x, '{MARKED}'))) AS marked,
           len(list_filter(words, lambda x: regexp_matches(x, '{STOPPED.replace("'", "''")}'))) AS stopped,
           regexp_matches(line, '{STOCK}') AS stock
    FROM worded WHERE len(words) > 0
), judged AS (
    SELECT r, n, chars, again,
           (separators > 0 AND 100 * separators >= {_R.separators} * n)
           OR 100 * marked >= {_R.marks} * n
           OR (n >= {_R.unstopped_words} AND stopped = 0)
           OR again
           OR (n <= {_R.phrase_words} AND stock) AS failed
    FROM measured
), summed AS (
    SELECT r, sum(n) AS n_words, sum(chars) AS word_chars,
           count(*) FILTER (WHERE again) AS n_dup_lines,
           coalesce(sum(chars) FILTER (WHERE failed), 0) AS lost
    FROM judged GROUP BY r
), whole AS (
    SELECT doc_id,
           coalesce(n_words, 0)::BIGINT AS n_words,
           coalesce(word_chars, 0)::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
           coalesce(lost, 0) AS lost
    FROM numbered LEFT JOIN summed USING (r) LEFT JOIN covered USING (r)
), based AS (
    SELECT *, n_words < {_R.min_words} OR 100 * n_repeat_words > {_R.max_repeat} * n_words
           AS base_failed
    FROM whole
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost <= {_R.max_loss} * word_chars AS kept
FROM based
"""

FILL_IN_MIDDLE = """
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
           sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
), drawn AS (
    SELECT doc_id, text, n,
           ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS one,
           ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS two,
           ('0x' || substr(h, 17, 8))::BIGINT % 100 AS three,
           ('0x' || substr(h, 25, 8))::BIGINT % 100 AS four
    FROM hashed
), formed AS (
    SELECT doc_id, text, n, least(one, two) AS a, greatest(one, two) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                     OR contains(text, '<M>') OR three >= 90 THEN 'plain'
                WHEN four < 20 THEN 'spm'
                ELSE 'psm' END AS form
    FROM drawn
), cut AS (
    SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle,
           substr(text, b + 1) AS suffix
    FROM formed
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                        ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""

SQL: dict[str, str] = {
    "op4_exact_dedup": EXACT_DEDUP,
    "op8_line_dedup": LINE_DEDUP,
    "op11_quality_rules": QUALITY_RULES,
    "op12_fill_in_middle": FILL_IN_MIDDLE,
}
