"""SQL for DuckDB that gives the rows of the registered queries."""

from __future__ import annotations

from .config import DEFAULTS
from .functions.text import BLOCK_MARKERS, CJK, VIETNAMESE

WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"
STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
GARBLED = r"[\x{0400}-\x{04FF}\x{FFFD}\x00-\x08\x0b\x0c\x0e-\x1f]"
NARRATIVE = r"(^|[^\p{L}\p{N}_])(em|tôi|mình|con|bé|cháu|bố|mẹ|chồng|vợ|anh|chị)($|[^\p{L}\p{N}_])"


def strip(expression: str) -> str:
    return STRIP.format(expression)


def tokens(words_only: bool = True) -> str:
    bigrams = "list_concat(w, [w[i] || '_' || w[i + 1] for i in range(1, len(w))])"
    return "w" if words_only else bigrams


def lang_of(s: str) -> str:
    head = f"substr({s}, 1, 4000)"
    n = lambda text, chars: f"len(regexp_extract_all({text}, '{chars}'))"
    letters = n(head, r"\p{L}")
    return f"CASE WHEN {letters} = 0 THEN 'other' WHEN {n(head, CJK)} / {letters} > 0.2 THEN 'zh' WHEN {n(f'lower({head})', VIETNAMESE)} / {letters} > 0.03 THEN 'vi' ELSE 'en' END"


def garbled(s: str) -> str:
    return f"coalesce(len(regexp_extract_all(substr({s}, 1, 3000), '{GARBLED}')) / nullif(length(substr({s}, 1, 3000)), 0) > 0.1, false)"


#: Pages' text: bodies of three tags, then tags, then runs of blanks.
FALLBACK = r"regexp_replace(regexp_replace(regexp_replace(html, '(?s)<script\b.*?</script>|<style\b.*?</style>|<noscript\b.*?</noscript>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '[ \t]+', ' ', 'g')"


def structured(page: str) -> str:
    """Pages' text with headings as lines that begin with hashes."""
    text = rf"regexp_replace({page}, '(?is)<script\b.*?</script>|<style\b.*?</style>|<noscript\b.*?</noscript>|<head\b.*?</head>', ' ', 'g')"
    for level in range(1, 7):
        text = rf"regexp_replace({text}, '(?is)<h{level}\b[^>]*>(.*?)</h{level}>', chr(10) || chr(10) || '{'#' * level} \1' || chr(10) || chr(10), 'g')"
    text = rf"regexp_replace({text}, '(?i)</(p|div|li|tr|ul|ol|table|article|section|nav)>|<br\s*/?>', chr(10), 'g')"
    text = rf"regexp_replace(regexp_replace({text}, '<[^>]+>', ' ', 'g'), '[ \t]+', ' ', 'g')"
    return strip(rf"regexp_replace(regexp_replace({text}, ' *\n *', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')")


HOST = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"


def bm25(name: str, docs: str, queries: str, k: int) -> str:
    """CTEs <name>_k (qid, lang, cid, score, rank); ``docs`` gives cid, lang, t and ``queries`` qid, t."""
    return f"""
    {name}_d AS (SELECT cid, lang, CASE WHEN len(t) = 0 THEN ['∅'] ELSE t END AS t FROM ({docs})),
    {name}_s AS (SELECT lang, count(*) AS n, avg(len(t)) AS a FROM {name}_d GROUP BY lang),
    {name}_q AS (SELECT qid, term, count(*) AS times FROM (SELECT qid, unnest(t) AS term FROM ({queries})) GROUP BY ALL),
    {name}_p AS (SELECT lang, cid, dl, term, count(*) AS tf FROM (SELECT lang, cid, len(t) AS dl, unnest(t) AS term FROM {name}_d) WHERE term IN (SELECT term FROM {name}_q) GROUP BY ALL),
    {name}_f AS (SELECT lang, term, count(*) AS df FROM {name}_p GROUP BY ALL),
    {name}_r AS (
        SELECT qid, p.lang, cid, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + {DEFAULTS.bm25_k1} * (1 - {DEFAULTS.bm25_b} + {DEFAULTS.bm25_b} * dl / a)) * times) AS score
        FROM {name}_p AS p JOIN {name}_f AS f ON p.lang = f.lang AND p.term = f.term JOIN {name}_s AS s ON p.lang = s.lang JOIN {name}_q AS q ON p.term = q.term GROUP BY ALL),
    {name}_k AS (SELECT *, row_number() OVER (PARTITION BY qid, lang ORDER BY round(score, 6) DESC, cid) AS rank FROM {name}_r QUALIFY rank <= {k})"""


def doc_tokens(words_only: bool = True, lang: str = "''") -> str:
    return f"SELECT doc_id AS cid, {lang} AS lang, {tokens(words_only)} AS t FROM (SELECT doc_id, lang, {WORDS} AS w FROM documents)"


def query_tokens(words_only: bool = True) -> str:
    return f"SELECT item_id AS qid, {tokens(words_only)} AS t FROM (SELECT item_id, {WORDS} AS w FROM benchmark)"


def top(name: str, columns: str = "qid AS query_id, cid AS doc_id") -> str:
    return f"SELECT {columns}, rank, round(score, 6) AS score FROM {name}_k WHERE score > 0"


def fused(lists: str, n: int) -> str:
    """The first n of each query by reciprocal ranks of rows (qid, list_name, cid, rank, weight)."""
    return f"""
    once AS (SELECT qid, list_name, cid, weight, row_number() OVER (PARTITION BY qid, list_name ORDER BY rank, cid) AS r FROM ({lists})),
    summed AS (SELECT qid, cid, sum(weight / (60 + r)) AS score FROM once GROUP BY ALL),
    placed AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, cid) AS rank FROM summed QUALIFY rank <= {n})
    SELECT qid AS query_id, cid AS doc_id, rank, round(score, 9) AS score FROM placed"""


PASSAGES = f"""
    lines AS (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ordinal FROM documents),
    passages AS (SELECT doc_id || ':' || ordinal AS chunk_id, doc_id, ordinal, text, lang FROM lines WHERE {strip("text")} <> '')"""


def line_tokens(words_only: bool = True) -> str:
    return f"SELECT chunk_id AS cid, '' AS lang, {tokens(words_only)} AS t FROM (SELECT chunk_id, {WORDS} AS w FROM passages)"


RANKED = f"""{PASSAGES}, {bm25("b", line_tokens(), query_tokens(), 60)},
    ranked AS (
        SELECT qid AS query_id, doc_id, cid AS chunk_id, text, rank, 1 / (60 + rank) AS score, row_number() OVER (PARTITION BY qid, doc_id ORDER BY round(1 / (60 + rank), 9) DESC, rank) AS place
        FROM b_k JOIN passages ON cid = chunk_id WHERE b_k.score > 0),
    scored AS (
        SELECT query_id, doc_id, sum(CASE WHEN place = 1 THEN score WHEN place <= 3 THEN 0.1 * score ELSE 0 END) AS rel,
            max(CASE WHEN place = 1 THEN score END) AS top_score, max(CASE WHEN place = 1 THEN chunk_id END) AS best_chunk, min(rank) AS first_rank
        FROM ranked GROUP BY ALL)"""


def agreed(cluster: str = "doc_id") -> str:
    return f"""{RANKED},
    with_meta AS (
        SELECT s.*, {cluster} AS cluster, d.source AS host, d.lang, e.embedding::DOUBLE[] AS v, max(rel) OVER (PARTITION BY query_id) AS best
        FROM scored AS s JOIN documents AS d USING (doc_id) JOIN embeddings AS e ON e.vec_id = s.doc_id % (SELECT count(*) FROM embeddings)),
    pairs AS (
        SELECT a.query_id, a.doc_id, b.host FROM with_meta AS a JOIN with_meta AS b ON a.query_id = b.query_id AND a.doc_id <> b.doc_id AND a.cluster <> b.cluster AND a.host <> b.host
        WHERE b.rel >= 0.3 * b.best AND list_inner_product(a.v, b.v) / ((sqrt(list_inner_product(a.v, a.v)) + 1e-9) * (sqrt(list_inner_product(b.v, b.v)) + 1e-9)) >= 0.2),
    support AS (SELECT query_id, doc_id, list_sort(list(DISTINCT host)) AS hosts FROM pairs GROUP BY ALL),
    final AS (SELECT w.*, coalesce(hosts, []) AS hosts, rel * (1 + 0.3 * ln(1 + len(coalesce(hosts, [])))) AS final FROM with_meta AS w LEFT JOIN support USING (query_id, doc_id))"""


CHOSEN = f"""{agreed()},
    capped AS (
        SELECT *, row_number() OVER (PARTITION BY query_id, host ORDER BY round(final, 9) DESC, first_rank, doc_id) AS of_host, max(final) OVER (PARTITION BY query_id) AS best_final FROM final),
    chosen AS (
        SELECT * EXCLUDE (of_host), row_number() OVER (PARTITION BY query_id ORDER BY round(final, 9) DESC, first_rank, doc_id) AS rank
        FROM capped WHERE of_host <= 2 QUALIFY rank <= 8 AND (rank <= 1 OR (best_final > 0 AND final / best_final >= 0.55)))"""

PICKED = f"""{CHOSEN},
    picked AS (
        SELECT r.query_id, r.doc_id, c.rank, r.place, r.chunk_id, r.text FROM ranked AS r JOIN chosen AS c ON r.query_id = c.query_id AND r.doc_id = c.doc_id
        WHERE r.place <= 3 AND c.top_score > 0 AND r.score / c.top_score >= 0.6)"""

GOLD = "gold AS (SELECT b.item_id AS id, d.doc_id, b.text AS passage FROM benchmark AS b JOIN documents AS d ON contains(d.text, b.text))"

INTERLEAVED = f"SELECT page_id AS id, {HOST} AS host, (row_number() OVER (PARTITION BY {HOST} ORDER BY page_id) - 1) / count(*) OVER (PARTITION BY {HOST}) AS turn FROM pages"
LINES = f"""
    every AS (SELECT doc_id, source AS host, unnest(string_split(text, chr(10))) AS line FROM documents),
    once AS (SELECT DISTINCT doc_id, host, {strip("line")} AS line FROM every),
    sizes AS (SELECT source AS host, count(*) AS docs FROM documents GROUP BY ALL),
    boiler AS (SELECT host, line, count(*) AS n FROM once JOIN sizes USING (host) WHERE length(line) > 0 AND length(line) < 200 GROUP BY host, line, docs HAVING n >= 8 AND n >= 0.05 * docs)"""
CLEANED = f"""{LINES},
    placed AS (SELECT doc_id, source AS host, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents),
    kept AS (SELECT p.doc_id, string_agg(p.line, chr(10) ORDER BY k) AS t FROM placed AS p LEFT JOIN boiler AS b ON p.host = b.host AND {strip("p.line")} = b.line WHERE b.line IS NULL GROUP BY p.doc_id),
    cleaned AS (SELECT doc_id, {strip("t")} AS text FROM kept WHERE {strip("t")} <> '')"""


def signatures(docs: str) -> str:
    return f"""
    words AS (SELECT doc_id, regexp_extract_all(lower(substr(text, 1, 4000)), '[\\p{{L}}\\p{{N}}]+') AS w FROM {docs}),
    tok AS (SELECT doc_id, {tokens(False)} AS t FROM words),
    terms AS (SELECT doc_id, term, count(*) AS c FROM (SELECT doc_id, unnest(t) AS term FROM tok WHERE len(t) >= 60) GROUP BY ALL),
    halves AS (SELECT doc_id, c, ('0x' || substr(md5(term), 1, 8))::BIGINT AS h, ('0x' || substr(md5(term), 9, 8))::BIGINT AS l FROM terms),
    bits AS (SELECT doc_id, k, sum(CASE WHEN (h >> k) & 1 = 1 THEN c ELSE -c END) AS vh, sum(CASE WHEN (l >> k) & 1 = 1 THEN c ELSE -c END) AS vl FROM halves, range(32) AS r(k) GROUP BY ALL),
    sigs AS (SELECT doc_id, sum(CASE WHEN vh > 0 THEN 1::BIGINT << k ELSE 0 END)::BIGINT AS sig_high, sum(CASE WHEN vl > 0 THEN 1::BIGINT << k ELSE 0 END)::BIGINT AS sig_low FROM bits GROUP BY ALL)"""


def clusters() -> str:
    """CTEs reps (doc_id, cluster_id) and sizes_of (cluster_id, n): band after band, documents of a bucket in turn.

    A document that no earlier band took joins the first one of its bucket that stands for itself and is near, or stands for
    itself from then on.
    """
    ctes, before = [], None
    for band, key in enumerate(("sig_low & 65535", "sig_low >> 16", "sig_high & 65535", "sig_high >> 16")):
        free = f"WHERE doc_id NOT IN (SELECT doc_id FROM taken{before})" if before is not None else ""
        held = f"SELECT doc_id, rep FROM taken{before} UNION ALL " if before is not None else ""
        ctes.append(f"""
    bucket{band} AS (SELECT doc_id, sig_high, sig_low, {key} AS key FROM sigs QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY doc_id) <= 500),
    turn{band} AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id) AS pos FROM bucket{band} {free}),
    walk{band} AS (
        SELECT key, pos, doc_id, [{{'id': doc_id, 'h': sig_high, 'l': sig_low}}] AS heads, NULL::BIGINT AS rep FROM turn{band} WHERE pos = 1
        UNION ALL
        SELECT key, pos, doc_id, CASE WHEN found IS NULL THEN list_append(heads, {{'id': doc_id, 'h': sig_high, 'l': sig_low}}) ELSE heads END, found
        FROM (
            SELECT t.*, heads, [x.id for x in heads if bit_count(xor(x.h, sig_high))::BIGINT + bit_count(xor(x.l, sig_low)) <= 3][1] AS found
            FROM walk{band} AS w JOIN turn{band} AS t ON t.key = w.key AND t.pos = w.pos + 1)),
    taken{band} AS MATERIALIZED ({held}SELECT doc_id, rep FROM walk{band} WHERE rep IS NOT NULL)""")
        before = band
    return ",".join(ctes) + f""",
    reps AS (SELECT s.doc_id, coalesce(rep, s.doc_id) AS cluster_id FROM sigs AS s LEFT JOIN taken{before} AS t ON t.doc_id = s.doc_id),
    sizes_of AS (SELECT cluster_id, count(*) AS n FROM reps GROUP BY ALL HAVING n > 1)"""


POOL = "SELECT conv_id * 1000 + turn AS id, text AS query FROM conversations WHERE role = 'user'"
STRATA = rf"""
    pool AS ({POOL}),
    counted AS (SELECT id, query, len(list_filter(regexp_split_to_array(query, '\s+'), lambda x: x <> '')) AS n, regexp_matches(lower(query), '{NARRATIVE}') AS narrative FROM pool),
    edges AS (SELECT list_sort(list_distinct(quantile_cont(n, [0, 0.25, 0.5, 0.75, 1]))) AS e FROM counted),
    strata AS (SELECT id, query, len(list_filter(e[2:len(e) - 1], lambda x: x < n)) AS len_bin, narrative FROM counted, edges)"""
LABELS = """
    ev AS (SELECT event_id AS seq, user_id AS qid, event_type AS kind, trunc(value)::INT::VARCHAR AS v, (event_id % 7)::VARCHAR AS m, (event_id % 5)::VARCHAR AS c FROM events),
    last AS (SELECT qid, arg_max(kind, seq) AS kind, arg_max(v, seq) AS v, arg_max(m, seq) AS m, arg_max(c, seq) AS c FROM ev GROUP BY qid),
    named AS (SELECT qid, kind, CASE WHEN kind = 'signup' THEN [] WHEN v = m THEN [v] ELSE [v, m] END AS d, c FROM last),
    whole AS (SELECT qid, kind, CASE WHEN kind = 'click' AND NOT list_contains(d, c) THEN list_append(d, c) ELSE d END AS docs FROM named),
    state AS (SELECT qid, kind, docs, CASE WHEN kind = 'purchase' AND len(docs) > 0 THEN 'gold' WHEN kind = 'error' THEN 'skipped' WHEN len(docs) > 0 THEN 'draft' ELSE 'none' END AS state FROM whole),
    labelled AS (SELECT *, CASE state WHEN 'gold' THEN 'done' WHEN 'skipped' THEN 'skip' ELSE 'todo' END AS status FROM state)"""


METRIC = r"list_filter(regexp_split_to_array(lower({0}), '\s+'), lambda x: x <> '')"


def lcs(pairs: str) -> str:
    """CTEs ending in lcs (k, n): the longest common subsequence of each of the ``pairs`` (k, a, b), row by row."""
    return f"""
    lcs_pairs AS ({pairs}),
    folded(k, a, b, i, r) AS (
        SELECT k, a, b, 0::BIGINT, list_transform(range(len(b) + 1), lambda x: 0::BIGINT) FROM lcs_pairs
        UNION ALL
        SELECT k, a, b, i + 1, list_transform(range(1, len(b) + 2), lambda j: list_max(c[1:j])) FROM (
            SELECT k, a, b, i, list_transform(range(1, len(b) + 2), lambda j: CASE WHEN j > 1 AND b[j - 1] = a[i + 1] THEN greatest(r[j], r[j - 1] + 1) ELSE r[j] END) AS c FROM folded WHERE i < len(a))),
    lcs AS (SELECT k, r[len(b) + 1] AS n FROM folded WHERE i = len(a))"""


#: Submitted and gold passages, and by query the shares that match: an LCS of two fifths of the gold passage's tokens.
PASSAGES_RATED = f"""{{0}}, {GOLD.replace("gold AS", "gold AS MATERIALIZED")},
    sent AS (SELECT p.query_id AS id, p.doc_id, row_number() OVER (ORDER BY p.query_id, p.rank, p.place) AS pp, {METRIC.format("p.text")} AS a FROM picked AS p JOIN (SELECT DISTINCT id FROM gold) AS g ON g.id = p.query_id),
    due AS (SELECT id, doc_id, row_number() OVER (ORDER BY id, doc_id) AS gp, {METRIC.format("passage")} AS b FROM gold),
    mates AS (SELECT row_number() OVER () AS k, sent.id, pp, gp, a, b FROM sent JOIN due ON sent.id = due.id AND sent.doc_id = due.doc_id),
    {lcs("SELECT k, a, b FROM mates")},
    met AS (SELECT id, count(DISTINCT pp) AS mp, count(DISTINCT gp) AS mg FROM mates JOIN lcs USING (k) WHERE len(b) > 0 AND n / len(b) >= {DEFAULTS.chunk_match} GROUP BY id),
    parts AS (
        SELECT g.id, coalesce(coalesce(mp, 0) / nullif(np, 0), 0) AS chunk_p, coalesce(mg, 0) / ng AS chunk_r FROM (SELECT id, count(*) AS ng FROM due GROUP BY id) AS g
        LEFT JOIN (SELECT id, count(*) AS np FROM sent GROUP BY id) AS s USING (id) LEFT JOIN met USING (id)),
    chunk AS (SELECT *, coalesce(5 * chunk_p * chunk_r / nullif(4 * chunk_p + chunk_r, 0), 0) AS chunk_f2 FROM parts)"""

DOCS_RATED = """
    dg AS (SELECT id, count(DISTINCT doc_id) AS ng FROM gold GROUP BY id), dp AS (SELECT query_id AS id, count(DISTINCT doc_id) AS np FROM chosen GROUP BY query_id),
    dm AS (SELECT gold.id, count(DISTINCT c.doc_id) AS nm FROM gold JOIN chosen AS c ON c.query_id = gold.id AND c.doc_id = gold.doc_id GROUP BY gold.id),
    dr AS (SELECT id, coalesce(coalesce(nm, 0) / nullif(np, 0), 0) AS doc_p, coalesce(nm, 0) / ng AS doc_r FROM dg LEFT JOIN dp USING (id) LEFT JOIN dm USING (id)),
    docs AS (SELECT *, coalesce(5 * doc_p * doc_r / nullif(4 * doc_p + doc_r, 0), 0) AS doc_f2 FROM dr)"""

SAMPLED = f"""{STRATA},
    quota AS (SELECT len_bin, narrative, round_even(count(*) * 80 / sum(count(*)) OVER (), 0) AS q FROM strata GROUP BY ALL),
    placed AS (SELECT id, s.len_bin, s.narrative, row_number() OVER (PARTITION BY s.len_bin, s.narrative ORDER BY md5('42:' || id), id) > q AS over_quota FROM strata AS s JOIN quota AS t ON s.len_bin = t.len_bin AND s.narrative = t.narrative),
    sampled AS (SELECT id, len_bin, narrative FROM placed ORDER BY over_quota, md5('42:' || id), id LIMIT 80)"""


def evaluated(name: str) -> str:
    return f"round({name}, 6) AS {name}"


blocked = " OR ".join(["length(t) < 150", *(f"contains(substr(t, 1, 2000), '{m}')" for m in BLOCK_MARKERS)])
dense = """WITH q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id % 100 = 0),
    r AS (SELECT query_id, vec_id, list_inner_product(q, embedding::DOUBLE[]) AS score FROM q, embeddings WHERE {0})
    SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, vec_id) AS rank, round(score, 6) AS score FROM r QUALIFY rank <= 10"""

ORACLES: dict[str, str] = {
    "detect_lang": f"SELECT doc_id, {lang_of('text')} AS detected FROM documents",
    "approx_tokens": rf"SELECT doc_id, greatest(len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) + len(regexp_extract_all(text, '{CJK}')), length(text) // 8) AS tokens FROM documents",
    "is_garbled": f"SELECT doc_id, {garbled('text')} AS garbled FROM documents",
    "lexical_tokens": f"SELECT doc_id, len(t) AS n, md5(array_to_string(t, ' ')) AS tokens_md5 FROM (SELECT doc_id, {tokens(False)} AS t FROM (SELECT doc_id, {WORDS} AS w FROM documents))",
    "sentence_split": rf"""SELECT doc_id, len(s) AS n, md5(array_to_string(s, chr(10))) AS sentences_md5 FROM (
        SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?。！？])\s+', '\1' || chr(10), 'g'), chr(10)), lambda x: {strip("x")}), lambda x: x <> '') AS s FROM documents)""",
    "url_host": f"SELECT page_id, {HOST} AS host FROM pages",
    "narrative": rf"SELECT conv_id, turn, regexp_matches(lower(text), '{NARRATIVE}') AS narrative, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS words FROM conversations",
    "html_fallback_text": f"SELECT page_id, length(t) AS n_chars, md5(t) AS text_md5 FROM (SELECT page_id, {FALLBACK} AS t FROM pages)",
    "html_title": f"SELECT page_id, {strip('''regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)''')} AS title FROM pages",
    "embed_text": "SELECT doc_id, md5(CASE WHEN coalesce(source, '') <> '' THEN source || chr(10) || text ELSE text END) AS embed_md5 FROM documents",
    "pdf_dispatch": "SELECT page_id, split_part(lower(url), '?', 1) LIKE '%.pdf' AS pdf FROM pages",
    "decode_html": "SELECT page_id, md5(html) AS text_md5 FROM pages",
    "query_scan": "SELECT item_id AS id, length(text) AS n_chars FROM benchmark",
    "boilerplate_lines": f"WITH {LINES} SELECT host, line, n FROM boiler",
    "clean_docs": f"WITH {CLEANED} SELECT doc_id, length(text) AS n_chars, md5(text) AS text_md5 FROM cleaned",
    "first_record_per_id": "SELECT user_id AS id, min(event_id) AS seq, arg_min(event_type, event_id) AS status FROM events GROUP BY user_id",
    "last_status_per_id": "SELECT user_id AS id, arg_max(event_type, event_id) AS status FROM events GROUP BY user_id",
    "crawl_summary": "SELECT status, count(*) AS n FROM (SELECT arg_max(event_type, event_id) AS status FROM events GROUP BY user_id) GROUP BY status",
    "resume_todo": "SELECT c_custkey::BIGINT AS id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)",
    "resume_retry": "SELECT c_custkey::BIGINT AS id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events GROUP BY user_id HAVING arg_max(event_type, event_id) = 'view')",
    "host_filter": "SELECT c_custkey::BIGINT AS id FROM customer WHERE c_mktsegment = 'BUILDING'",
    "interleave_hosts": f"SELECT id, host, round(turn, 9) AS turn FROM ({INTERLEAVED})",
    "sample_per_host": f"SELECT page_id AS id, {HOST} AS host FROM pages QUALIFY row_number() OVER (PARTITION BY {HOST} ORDER BY md5('0:' || page_id), page_id) <= 3",
    "sample_links": "SELECT page_id AS id FROM pages ORDER BY md5('1:' || page_id), page_id LIMIT 50",
    "throttle_plan": f"SELECT id, (row_number() OVER (PARTITION BY host ORDER BY turn, id) - 1) * 1.0::DOUBLE AS start_s FROM ({INTERLEAVED})",
    "classify_page": rf"""WITH x AS (SELECT page_id AS id, {strip(f"regexp_replace({FALLBACK}, '\n{{3,}}', chr(10) || chr(10), 'g')")} AS t FROM pages),
        y AS (SELECT id, t, CASE WHEN length(t) < 50 THEN 'empty' WHEN {blocked} THEN 'blocked' WHEN {garbled("t")} THEN 'garbled' ELSE 'ok' END AS status FROM x)
        SELECT id, status, CASE WHEN status = 'ok' THEN {lang_of("t")} ELSE 'other' END AS lang, CASE WHEN status = 'ok' THEN length(t) ELSE 0 END AS n_chars FROM y""",
    "garbled_per_host": f"SELECT source AS host, count(*) AS n FROM (SELECT source, CASE WHEN lang = 'de' THEN repeat('\ufffd', 400) || text ELSE text END AS text FROM documents) WHERE {garbled('text')} GROUP BY source",
    "repair_overlay": "SELECT doc_id AS id, md5(text) AS text_md5 FROM documents WHERE lang <> 'de' OR source <> 'src1'",
    "simhash": f"WITH {signatures('documents')} SELECT d.doc_id, sig_high, sig_low FROM documents AS d LEFT JOIN sigs USING (doc_id)",
    "lsh_pairs": f"""WITH {signatures('documents')}
        , firsts AS (SELECT min(doc_id) AS doc_id, sig_high, sig_low FROM sigs GROUP BY sig_high, sig_low)
        SELECT a.doc_id AS a, b.doc_id AS b, bit_count(xor(a.sig_high, b.sig_high))::BIGINT + bit_count(xor(a.sig_low, b.sig_low)) AS distance
        FROM firsts AS a JOIN firsts AS b ON a.doc_id < b.doc_id WHERE bit_count(xor(a.sig_high, b.sig_high))::BIGINT + bit_count(xor(a.sig_low, b.sig_low)) <= 3
        UNION ALL SELECT f.doc_id, s.doc_id, 0 FROM sigs AS s JOIN firsts AS f USING (sig_high, sig_low) WHERE s.doc_id > f.doc_id""",
    "dup_clusters": f"WITH RECURSIVE {CLEANED}, {signatures('cleaned')}, {clusters()} SELECT doc_id, cluster_id FROM reps WHERE cluster_id IN (SELECT cluster_id FROM sizes_of)",
    "cluster_counts": f"""WITH RECURSIVE {CLEANED}, {signatures('cleaned')}, {clusters()}
        SELECT (SELECT count(*) FROM cleaned) AS docs, coalesce(sum(n), 0)::BIGINT AS docs_in_clusters, count(*) AS clusters FROM sizes_of""",
    "bm25_topk": f"WITH {bm25('b', doc_tokens(False), query_tokens(False), 10)} {top('b')}",
    "bm25_by_lang": f"WITH {bm25('b', doc_tokens(True, 'lang'), query_tokens(), 5)} {top('b', 'qid AS query_id, lang, cid AS doc_id')}",
    "bm25_statistics": f"SELECT lang, count(*) AS n, round(avg(greatest(len({WORDS}), 1)), 6) AS avgdl FROM documents GROUP BY lang",
    "dense_topk": dense.format("true"),
    "dense_topk_filtered": dense.format("label IN (0, 1, 2, 3, 4)"),
    "vector_lookup": """SELECT row_number() OVER (ORDER BY vec_id DESC) AS position, vec_id AS chunk_id, round(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 5) AS length
        FROM embeddings WHERE vec_id % 100 = 0""",
    "index_mismatch": """SELECT doc_id AS chunk_id, 'vector' AS missing FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)
        UNION ALL SELECT vec_id, 'chunk' FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents)""",
    "rrf_fusion": f"""WITH {bm25("a", doc_tokens(False), query_tokens(False), 30)}, {bm25("b", doc_tokens(), query_tokens(), 30)},
        {fused("SELECT qid, 'o' AS list_name, cid, rank, 2.0::DOUBLE AS weight FROM a_k WHERE score > 0 UNION ALL SELECT qid, 'w', cid, rank, 1.0 FROM b_k WHERE score > 0", 20)}""",
    "stratified_fusion": f"WITH {bm25('b', doc_tokens(True, 'lang'), query_tokens(), 30)}, {fused('SELECT qid, lang AS list_name, cid, rank, 1.0::DOUBLE AS weight FROM b_k WHERE score > 0', 60)}",
    "doc_scores": f"WITH {RANKED} SELECT query_id, doc_id, round(rel, 6) AS rel, round(top_score, 6) AS top_score, best_chunk, first_rank FROM scored",
    "agreement_rescore": f"WITH {agreed()} SELECT query_id, doc_id, len(hosts) AS support, array_to_string(hosts, ',') AS hosts, round(final, 6) AS final FROM final",
    "page_sections": rf"""WITH
        p AS (SELECT page_id, {strip("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title, string_split({structured("html")}, chr(10)) AS lines FROM pages),
        l AS (SELECT page_id, title, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM p),
        h AS (SELECT *, CASE WHEN regexp_matches(line, '^#{{1,6}}\s') THEN length(regexp_extract(line, '^#+')) END AS level FROM l),
        s AS (SELECT *, count(level) OVER (PARTITION BY page_id ORDER BY pos) AS section FROM h),
        bodies AS (SELECT page_id, title, section, {strip("string_agg(line, chr(10) ORDER BY pos)")} AS body FROM s WHERE level IS NULL GROUP BY ALL HAVING body <> ''),
        heads AS (SELECT page_id, section, level, {strip("regexp_replace(line, '^#+', '')")} AS name FROM s WHERE level IS NOT NULL),
        above AS (
            SELECT b.page_id, b.section, list(a.name ORDER BY a.level) AS names FROM bodies AS b JOIN heads AS a ON a.page_id = b.page_id AND a.section <= b.section
            WHERE NOT EXISTS (SELECT 1 FROM heads AS c WHERE c.page_id = b.page_id AND c.section > a.section AND c.section <= b.section AND c.level <= a.level) GROUP BY ALL)
        SELECT b.page_id, (row_number() OVER (PARTITION BY b.page_id ORDER BY b.section) - 1)::INTEGER AS ordinal,
            array_to_string(list_concat(CASE WHEN title <> '' THEN [title] ELSE [] END, coalesce(names, [])), ' > ') AS context, length(body) AS n_chars
        FROM bodies AS b LEFT JOIN above AS a ON a.page_id = b.page_id AND a.section = b.section""",
    "select_docs_dedupe": f"""WITH RECURSIVE {agreed("CASE WHEN doc_id % 2 = 0 THEN doc_id % 6 ELSE doc_id END")},
        rated AS (SELECT *, max(final) OVER (PARTITION BY query_id) AS top_final FROM final),
        line AS MATERIALIZED (
            SELECT query_id, doc_id, host, cluster, CASE WHEN top_final > 0 THEN final / top_final ELSE 0 END AS share,
                row_number() OVER (PARTITION BY query_id ORDER BY round(final, 9) DESC, first_rank, doc_id) AS pos FROM rated),
        walk AS (
            SELECT DISTINCT query_id, 0::BIGINT AS pos, []::BIGINT[] AS docs, []::VARCHAR[] AS hosts, []::BIGINT[] AS clusters FROM line
            UNION ALL
            SELECT query_id, pos, CASE WHEN take THEN list_append(docs, doc_id) ELSE docs END, CASE WHEN take THEN list_append(hosts, host) ELSE hosts END, CASE WHEN take THEN list_append(clusters, cluster) ELSE clusters END
            FROM (
                SELECT l.*, docs, hosts, clusters,
                    len([h for h in hosts if h = host]) < 2 AND NOT list_contains(clusters, cluster) AND (len(docs) < 1 OR (share >= 0.55 AND len(docs) < 8)) AS take
                FROM walk AS w JOIN line AS l ON l.query_id = w.query_id AND l.pos = w.pos + 1)),
        ended AS (SELECT query_id, docs FROM walk QUALIFY pos = max(pos) OVER (PARTITION BY query_id))
        SELECT query_id, unnest(docs) AS doc_id, generate_subscripts(docs, 1) AS rank FROM ended""",
    "select_docs": f"WITH {CHOSEN} SELECT query_id, doc_id, rank FROM chosen",
    "pick_chunks": f"WITH {PICKED} SELECT query_id, doc_id, place, chunk_id, md5(text) AS text_md5 FROM picked",
    "submission_rows": f"""WITH {PICKED},
        d AS (SELECT query_id, string_agg(doc_id::VARCHAR, ',' ORDER BY rank) AS docs FROM chosen GROUP BY query_id), c AS (SELECT query_id, count(*) AS chunks FROM picked GROUP BY query_id)
        SELECT item_id AS id, coalesce(docs, '') AS docs, coalesce(chunks, 0) AS chunks FROM benchmark LEFT JOIN d ON item_id = d.query_id LEFT JOIN c ON item_id = c.query_id""",
    "validate_submission": """SELECT 'missing' AS kind, doc_id AS id, 'no record' AS message FROM documents WHERE doc_id NOT IN (SELECT item_id FROM benchmark)
        UNION ALL SELECT 'unexpected', item_id, 'not asked for' FROM benchmark WHERE item_id NOT IN (SELECT doc_id FROM documents) ORDER BY kind, id, message LIMIT 50""",
    "diversity": f"""WITH {CHOSEN}, c AS (
            SELECT query_id, count(*) AS docs, count(DISTINCT host) AS hosts, count(DISTINCT lang) AS langs, count(*) FILTER (len(hosts) > 0) AS corroborated FROM (SELECT query_id, host, lang, hosts FROM chosen) GROUP BY query_id)
        SELECT item_id AS query_id, coalesce(docs, 0) AS docs, coalesce(hosts, 0) AS hosts, coalesce(langs, 0) AS langs, coalesce(corroborated, 0) AS corroborated, coalesce(hosts, 0) <= 1 AS single_source
        FROM benchmark LEFT JOIN c ON item_id = query_id""",
    "bias_report": f"""WITH {CHOSEN},
        per AS (SELECT query_id, count(*) AS n, count(DISTINCT host) AS h, max(len(hosts)) AS s FROM chosen GROUP BY query_id),
        l AS (SELECT lang AS name, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM chosen GROUP BY lang),
        h AS (SELECT host AS name, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM chosen GROUP BY host),
        told AS (
            SELECT 'queries' AS measure, '' AS name, count(*)::DOUBLE AS value FROM per UNION ALL SELECT 'docs_per_query', '', avg(n) FROM per
            UNION ALL SELECT 'single_source', '', count(*) FILTER (h <= 1) FROM per UNION ALL SELECT 'corroborated', '', count(*) FILTER (s > 0) FROM per
            UNION ALL SELECT 'lang_share', name, share FROM l UNION ALL SELECT 'lang_entropy', '', -sum(share * log2(share)) FROM l
            UNION ALL (SELECT 'host_share', name, share FROM h ORDER BY n DESC, name LIMIT 5) UNION ALL SELECT 'host_entropy', '', -sum(share * log2(share)) FROM h)
        SELECT measure, name, round(value, 6) AS value FROM told""",
    "doc_prf": f"""WITH {CHOSEN}, {GOLD},
        g AS (SELECT id, count(DISTINCT doc_id) AS ng FROM gold GROUP BY id), p AS (SELECT query_id AS id, count(DISTINCT doc_id) AS np FROM chosen GROUP BY query_id),
        m AS (SELECT g.id, count(DISTINCT c.doc_id) AS nm FROM gold AS g JOIN chosen AS c ON c.query_id = g.id AND c.doc_id = g.doc_id GROUP BY g.id),
        r AS (SELECT id, coalesce(coalesce(nm, 0) / nullif(np, 0), 0) AS doc_p, coalesce(nm, 0) / ng AS doc_r FROM g LEFT JOIN p USING (id) LEFT JOIN m USING (id))
        SELECT id, {evaluated("doc_p")}, {evaluated("doc_r")}, round(coalesce(5 * doc_p * doc_r / nullif(4 * doc_p + doc_r, 0), 0), 6) AS doc_f2 FROM r""",
    "chunk_prf": f"WITH RECURSIVE {PASSAGES_RATED.format(PICKED)} SELECT id, {evaluated('chunk_p')}, {evaluated('chunk_r')}, {evaluated('chunk_f2')} FROM chunk",
    "evaluate_macro": f"""WITH RECURSIVE {PASSAGES_RATED.format(PICKED)}, {DOCS_RATED}
        SELECT count(*) AS n_queries, {", ".join(f"round(coalesce(avg({n}), 0), 6) AS {n}" for n in ("doc_p", "doc_r", "doc_f2", "chunk_p", "chunk_r", "chunk_f2"))} FROM docs JOIN chunk USING (id)""",
    "lcs_overlap": f"""WITH RECURSIVE m AS (SELECT item_id, {METRIC.format("text")} AS t FROM benchmark),
        {lcs("SELECT x.item_id AS k, x.t AS a, y.t AS b FROM m AS x JOIN m AS y ON y.item_id = x.item_id + 1")}
        SELECT k AS item_id, n AS lcs, round(coalesce(n / nullif(len(b), 0), 0), 6) AS share FROM lcs JOIN lcs_pairs USING (k)""",
    "line_split": f"SELECT doc_id, count(*) AS n, count(*) FILTER ({strip('line')} = '') AS blank FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY doc_id",
    "metric_tokens": rf"SELECT page_id, len(list_filter(regexp_split_to_array(lower(nfc_normalize(html)), '\s+'), lambda x: x <> '')) AS n FROM pages",
    "query_strata": f"WITH {STRATA} SELECT id, len_bin, narrative FROM strata",
    "dev_sample": f"WITH {SAMPLED} SELECT id FROM sampled",
    "dev_replacements": f"""WITH {SAMPLED},
        skipped AS (SELECT len_bin, narrative, row_number() OVER (ORDER BY md5('7:' || id), id) - 1 AS k FROM sampled WHERE id % 3 = 0),
        sizes AS (SELECT 80 - (SELECT count(*) FROM sampled) + count(*) AS need, count(*) AS n FROM skipped),
        demands AS (SELECT d, ('0x' || substr(md5('7:draw:' || d), 1, 8))::BIGINT % n AS k FROM (SELECT unnest(range(need)) AS d, n FROM sizes WHERE n > 0)),
        turns AS (SELECT d, len_bin, narrative, row_number() OVER (PARTITION BY len_bin, narrative ORDER BY d) AS turn FROM demands JOIN skipped USING (k)),
        pool2 AS (SELECT id, len_bin, narrative, row_number() OVER (PARTITION BY len_bin, narrative ORDER BY md5('7:' || id), id) AS turn FROM strata WHERE id NOT IN (SELECT id FROM sampled)),
        got AS (SELECT d, id FROM turns LEFT JOIN pool2 USING (len_bin, narrative, turn)),
        others AS (SELECT id, row_number() OVER (ORDER BY md5('7:' || id), id) AS turn FROM pool2 WHERE id NOT IN (SELECT id FROM got WHERE id IS NOT NULL)),
        rest AS (SELECT row_number() OVER (ORDER BY d) AS turn FROM got WHERE id IS NULL)
        SELECT id FROM got WHERE id IS NOT NULL UNION ALL SELECT id FROM others JOIN rest USING (turn)""",
    "label_state": f"""WITH {LABELS} SELECT qid, CASE WHEN state IN ('gold', 'draft') THEN array_to_string(docs, ',') ELSE '' END AS docs,
        CASE WHEN state IN ('gold', 'draft') AND kind = 'click' THEN 1 ELSE 0 END::BIGINT AS chunks, state, status FROM labelled""",
    "label_progress": f"WITH {LABELS} SELECT coalesce(status, 'todo') AS status, count(*) AS n FROM customer LEFT JOIN labelled ON c_custkey = qid GROUP BY ALL",
    "pooled_search": f"""WITH {PASSAGES}, {bm25("a", line_tokens(False), query_tokens(False), 40)}, {bm25("b", line_tokens(), query_tokens(), 40)},
        r AS (SELECT qid, 'bm25' AS mode, cid, rank FROM a_k WHERE score > 0 UNION ALL SELECT qid, 'words', cid, rank FROM b_k WHERE score > 0),
        n AS (SELECT qid, mode, doc_id, cid, rank FROM r JOIN passages ON cid = chunk_id),
        best AS (SELECT qid, mode, doc_id, min(rank) AS b FROM n GROUP BY ALL),
        ds AS (SELECT qid, doc_id, sum(1 / (60 + b)) AS doc_score, string_agg(mode, ',' ORDER BY mode) AS modes FROM best GROUP BY ALL),
        dr AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(doc_score, 9) DESC, doc_id) AS doc_rank FROM ds QUALIFY doc_rank <= 25),
        cs AS (SELECT qid, doc_id, cid, sum(1 / (60 + rank)) AS chunk_score FROM n GROUP BY ALL),
        cr AS (SELECT *, row_number() OVER (PARTITION BY qid, doc_id ORDER BY round(chunk_score, 9) DESC, cid) AS chunk_rank FROM cs QUALIFY chunk_rank <= 3)
        SELECT cr.qid AS query_id, cr.doc_id, cid AS chunk_id, modes, doc_rank, chunk_rank, round(doc_score, 9) AS doc_score, round(chunk_score, 9) AS chunk_score
        FROM cr JOIN dr ON cr.qid = dr.qid AND cr.doc_id = dr.doc_id""",
    "doc_lookup": "SELECT doc_id AS id, lang, md5(text) AS text_md5 FROM documents WHERE doc_id IN (3, 5, 8)",
    "corpus_health": f"WITH {PASSAGES} SELECT count(*) AS chunks, count(DISTINCT doc_id) AS docs, (SELECT count(*) FROM embeddings) AS points FROM passages",
}
