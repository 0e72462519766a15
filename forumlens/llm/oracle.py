"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from . import quality as Q

_WORDS = r"list_filter(regexp_split_to_array({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_TRIM = "trim({0}, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_CHARS = "length(array_to_string({0}, ''))"


def quality_sql(documents: str = "documents") -> str:
    """Rows of the quality query, with the cleaned text as ``clean_text``."""
    symbols = f"len(regexp_extract_all({{0}}, '{Q.SYMBOLS}'))"
    n = "len(regexp_split_to_array(s, ' +'))"
    fails = f"""s <> '' AND (
        (length(s) < {Q.BOILERPLATE_CHARS} AND regexp_matches(s, '{Q.BOILERPLATE}'))
        OR (length(s) < {Q.NAVIGATION_CHARS} AND regexp_matches(s, '{Q.NAVIGATION}'))
        OR regexp_matches(s, '{Q.NAV_MARKS}') OR {symbols.format('s')} > {Q.MAX_SYMBOL_SHARE} * {n}
        OR (NOT regexp_matches(right(s, {Q.END_CHARS}), '{Q.SENTENCE_END}') AND {n} < {Q.MIN_UNPUNCTUATED_WORDS}))"""
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w,
         string_split(coalesce(text, ''), chr(10)) AS ls
  FROM {documents}),
win AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n_rep FROM twice, range(3) AS o(k) GROUP BY r),
line AS (SELECT r, pos, l, {_TRIM.format('l')} AS s
         FROM (SELECT r, unnest(ls) AS l, unnest(range(len(ls))) AS pos FROM d)),
judged AS (SELECT *, {fails} AS fails FROM line),
per_doc AS (
  SELECT r, count(*) FILTER (s <> '') - count(DISTINCT l) FILTER (s <> '') AS n_dup,
         coalesce(sum({_CHARS.format(_WORDS.format('s'))}) FILTER (fails), 0) AS lost,
         coalesce(string_agg(l, chr(10) ORDER BY pos) FILTER (NOT fails), '') AS clean_text
  FROM judged GROUP BY r),
m AS (
  SELECT doc_id, len(w) AS n_words, {_CHARS.format('w')} AS word_chars, {symbols.format('t')} AS n_symbols,
         n_dup AS n_dup_lines, coalesce(n_rep, 0) AS n_repeat_words, lost, clean_text
  FROM d JOIN per_doc USING (r) LEFT JOIN rep USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       (n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       (n_words >= {Q.MIN_WORDS} AND 100 * n_repeat_words <= 50 * n_words
        AND lost <= {Q.MAX_LOST_SHARE} * word_chars) AS kept, clean_text
FROM m"""


SQL = {
    "op8_warc_index": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM p LEFT JOIN f USING (d)""",
    "op7_quality_rules": f"SELECT * EXCLUDE (clean_text) FROM ({quality_sql()})",
}
