"""SQL for DuckDB that gives the rows of those queries that SQL can express on whole tables."""

from __future__ import annotations

from .quality_rules import STOP_WORDS, THRESHOLDS
from .suffix_array import LENGTH as PASSAGE_WORDS
from .warc import REVISIT_BYTES

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _repeats(length: int) -> str:
    """Words covered by windows that start earlier elsewhere; doc_id is unique and not null."""
    return f"""
    WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
    windows AS (SELECT doc_id, i, array_to_string(w[i:i + {length - 1}], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - {length - 2})) AS i FROM d)),
    later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {length})) AS j FROM later),
    words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS j FROM d),
    kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS t FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id),
    runs AS (SELECT doc_id, min(j) - 1 AS a, max(j) AS b FROM (SELECT doc_id, j, j - row_number() OVER (PARTITION BY doc_id ORDER BY j) AS g FROM gone) GROUP BY doc_id, g),
    spans AS (SELECT doc_id, sum(b - a)::BIGINT AS n, string_agg(a || ':' || b, ',' ORDER BY a) AS spans FROM runs GROUP BY doc_id)
    SELECT d.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, coalesce(spans, '') AS spans, sha256(coalesce(t, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN spans USING (doc_id)"""


def _passes() -> str:
    sides = [f"coalesce({t.metric} {sign} {bound}, true)" for t in THRESHOLDS for sign, bound in ((">=", t.low), ("<=", t.high)) if bound is not None]
    return " AND ".join(sides)


ORACLES: dict[str, str] = {
    "op2_suffix_array_dedup": _repeats(PASSAGE_WORDS),
    "op4_quality_rules": rf"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
    l AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
    windows AS (SELECT rid, i, [w[i], w[i + 1], w[i + 2]] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
    twice AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
    covered AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY rid),
    m AS (
        SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
            len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
            len(list_filter(w, lambda x: lower(x) IN ({", ".join(f"'{s}'" for s in dict.fromkeys(STOP_WORDS))}))) AS n_stop, len(regexp_extract_all(t, '\p{{Lu}}')) AS n_upper
        FROM l LEFT JOIN covered USING (rid)),
    r AS (
        SELECT *, word_chars / nullif(n_words, 0) AS mean_word_chars, n_symbols / nullif(n_words, 0) AS symbol_ratio, n_upper / nullif(word_chars, 0) AS upper_ratio, n_stop / nullif(n_words, 0) AS stop_ratio,
            n_dup_lines / nullif(n_lines, 0) AS dup_line_ratio, n_repeat_words / nullif(n_words, 0) AS repeat_ratio, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
        FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_passes()} AS kept FROM r""",
    "op5_warc": f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
    t AS (SELECT *, CASE WHEN n >= {REVISIT_BYTES} THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS top FROM p)
    SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest, CASE WHEN top = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN top <> page_id THEN top END AS refers_to FROM t""",
    "op7_substring_dedup": _repeats(20),
    "op9_exact_dedup": """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
}
