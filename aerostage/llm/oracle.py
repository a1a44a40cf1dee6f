"""DuckDB SQL of this package's queries, where SQL can express them."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

MIXING = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS pos
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM d GROUP BY source),
o AS (SELECT *, 2.0 * source_size / w AS ratio FROM s),
p AS (
  -- level if the sources with a smaller ratio stop at their cap and the others share what is left by weight
  SELECT a.*, (1.5 * (SELECT sum(source_size::DOUBLE) FROM s)
               - coalesce((SELECT sum(2.0 * c.source_size) FROM o c WHERE c.ratio < a.ratio), 0))
              / (SELECT sum(c.w) FROM o c WHERE c.ratio >= a.ratio) AS own_level FROM o a),
t AS (SELECT *, (SELECT arg_min(own_level, ratio) FROM p WHERE 2.0 * source_size > own_level * w) AS level FROM p),
g AS (
  SELECT source, source_size, least(2.0 * source_size, coalesce(level * w, 2.0 * source_size)) AS target FROM t),
r AS (
  SELECT d.doc_id, d.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size) ELSE 0 END AS base,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY substr(pos, 1, 15)) - d.size AS before
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
c AS (
  SELECT *, (base + CASE WHEN source_size > 0 AND before + size / 2 <= target - base * source_size
                          AND target > base * source_size THEN 1 ELSE 0 END)::INT AS copies FROM r)
SELECT doc_id, size, source_size, target, copies, (size * copies)::BIGINT AS taken FROM c
"""

RULES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT k, doc_id, text, regexp_extract_all(text, '{WORD}') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM d),
u AS (SELECT k, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
g AS (SELECT k, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS win FROM u WINDOW o AS (PARTITION BY k ORDER BY i)),
m AS (SELECT k, i FROM (SELECT *, count(*) OVER (PARTITION BY k, win) AS n FROM g WHERE win IS NOT NULL) WHERE n >= 2),
c AS (SELECT k, count(DISTINCT j) AS n_repeat_words FROM (SELECT k, unnest([i, i + 1, i + 2]) AS j FROM m) GROUP BY k),
top AS (SELECT k, max(n) AS top FROM (SELECT k, word, count(*) AS n FROM u GROUP BY ALL) GROUP BY k),
f AS (
  SELECT w.k, doc_id, len(words)::BIGINT AS n_words, len(list_aggregate(words, 'string_agg', ''))::BIGINT AS chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(regexp_extract_all(text, '[\p{{Lu}}\p{{Lt}}]')) > len(regexp_extract_all(text, '[\p{{Ll}}\p{{Lm}}\p{{Lo}}]')) AS shouted,
         len(regexp_extract_all(text, '[!?]')) AS bangs,
         len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS lettered, coalesce(top, 0) AS top
  FROM w LEFT JOIN c USING (k) LEFT JOIN top USING (k)),
b AS (SELECT *, coalesce(chars, 0) AS word_chars, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 100 * n_dup_lines > 30 * n_lines OR shouted OR 10 * bangs > 3 * n_words OR 10 * lettered < 7 * n_words
            OR 100 * top > 30 * n_words) AS kept
FROM b
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_mixing": MIXING, "op10_quality_rules": RULES}
