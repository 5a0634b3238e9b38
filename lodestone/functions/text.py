"""Text functions as column expressions; the few that Catalyst has no expression for are Arrow functions below."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from .columns import adjacent, let, strip

# Character classes, markers and word lists.
CJK = "[㐀-䶿一-鿿豈-﫿]"
VIETNAMESE = "[àáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵđ]"
MOJIBAKE = r"[Ѐ-ӿ�\x00-\x08\x0b\x0c\x0e-\x1f]"
BLOCK_MARKERS = ("滑动拼图验证", "Just a moment...", "Attention Required! | Cloudflare", "访问验证")
NARRATIVE = r"(?iU)\b(em|tôi|mình|con|bé|cháu|bố|mẹ|chồng|vợ|anh|chị)\b"
WIDENED_CHARSETS = ("gb2312", "gbk", "gb18030", "x-gbk")

RUN = r"[\p{L}\p{N}]+"


def count_of(text: Column, pattern: str) -> Column:
    """Characters of the class ``pattern``: what a text loses without them. regexp_count makes an array of all of them."""
    return F.length(text) - F.length(F.regexp_replace(text, f"{pattern}+", ""))


def detect_lang(text: Column, strata: tuple[str, str, str, str] = ("zh", "vi", "en", "other")) -> Column:
    """By shares of letters in the first 4000 characters: CJK over 0.2, then Vietnamese accents over 0.03."""
    zh, vi, en, other = strata
    head = F.substring(F.coalesce(text, F.lit("")), 1, 4000)
    letters = F.length(F.regexp_replace(head, r"\P{L}+", ""))
    return (
        F.when(letters == 0, other)
        .when(F.try_divide(count_of(head, CJK), letters) > 0.2, zh)
        .when(F.try_divide(count_of(F.lower(head), VIETNAMESE), letters) > 0.03, vi)
        .otherwise(en)
    )


def is_garbled(text: Column, threshold: float = 0.1) -> Column:
    head = F.substring(F.coalesce(text, F.lit("")), 1, 3000)
    return F.coalesce(F.try_divide(count_of(head, MOJIBAKE), F.length(head)) > threshold, F.lit(False))


def word_list(text: Column) -> Column:
    """Words between white space of any kind."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(word_list(text))


def approx_tokens(text: Column) -> Column:
    """Words plus CJK characters, or an eighth of the length if that is more."""
    plain = F.coalesce(text, F.lit(""))
    return F.greatest(word_count(plain) + count_of(plain, CJK), F.floor(F.length(plain) / 8).cast("int"))


def lexical_words(text: Column) -> Column:
    """Runs of letters and digits, lower case. ``text`` is taken as unescaped and NFKC; see ``normalized``."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({RUN})"), F.lit(1))


def lexical_tokens(text: Column) -> Column:
    """Words and word bigrams; a run with CJK gives its CJK characters and their bigrams instead."""
    plain = F.lower(F.coalesce(text, F.lit("")))

    def of_run(run: Column) -> Column:
        chars = F.regexp_extract_all(run, F.lit(f"({CJK})"), F.lit(1))
        return F.when(run.rlike(CJK), let(chars, lambda c: F.concat(c, adjacent(c, lambda x, y: F.concat(x, y))))).otherwise(F.array(run))

    def with_bigrams(tokens: Column, latin: Column) -> Column:
        return F.concat(tokens, let(latin, lambda a: adjacent(a, lambda x, y: F.concat(x, F.lit("_"), y))))

    # Where no run has CJK, tokens needn't be matched one by one.
    mixed = let(F.flatten(F.transform(lexical_words(text), of_run)), lambda t: with_bigrams(t, F.filter(t, lambda x: ~x.rlike("^" + CJK))))
    return F.when(plain.rlike(CJK), mixed).otherwise(let(lexical_words(text), lambda t: with_bigrams(t, t)))


def looks_blocked(text: Column) -> Column:
    head = F.substring(text, 1, 2000)
    found = F.length(text) < 150
    for marker in BLOCK_MARKERS:
        found = found | head.contains(marker)
    return found


def collapse_blank_lines(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"\n{3,}", "\n\n"))


def html_fallback_text(page: Column) -> Column:
    """Without script, style and noscript bodies and without tags; runs of spaces and tabs as one space."""
    bare = F.regexp_replace(F.coalesce(page, F.lit("")), r"(?s)<(script|style|noscript)\b.*?</\1>", " ")
    return F.regexp_replace(F.regexp_replace(bare, "<[^>]+>", " "), "[ \t]+", " ")


def html_title(page: Column) -> Column:
    return strip(F.regexp_extract(F.coalesce(page, F.lit("")), r"(?is)<title[^>]*>(.*?)</title>", 1))


def html_structured_text(page: Column) -> Column:
    """Headings as markdown lines and block ends as line breaks, then as the fallback."""
    text = F.regexp_replace(F.coalesce(page, F.lit("")), r"(?is)<(script|style|noscript|head)\b.*?</\1>", " ")
    for level in range(1, 7):
        text = F.regexp_replace(text, rf"(?is)<h{level}\b[^>]*>(.*?)</h{level}>", "\n\n" + "#" * level + " $1\n\n")
    text = F.regexp_replace(text, r"(?i)</(p|div|li|tr|ul|ol|table|article|section|nav)>|<br\s*/?>", "\n")
    text = F.regexp_replace(F.regexp_replace(text, "<[^>]+>", " "), "[ \t]+", " ")
    return collapse_blank_lines(F.regexp_replace(text, r" *\n *", "\n"))


#: Elements that hold no content of a page.
BESIDES = "script|style|noscript|template|svg|iframe|head|nav|aside|footer|form"


def html_main_text(page: Column) -> Column:
    """Structured text of a page's ``main`` element, else of its articles, else of all, without navigation, asides, footers and forms."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(page, F.lit("")), r"(?s)<!--.*?-->", " "), rf"(?is)<({BESIDES})\b.*?</\1>", " ")

    def content(whole: Column) -> Column:
        main = F.regexp_extract(whole, r"(?is)<main\b[^>]*>(.*)</main>", 1)
        articles = F.array_join(F.regexp_extract_all(whole, F.lit(r"(?is)<article\b[^>]*>(.*?)</article>"), F.lit(1)), "\n")
        return F.when(main != "", main).when(articles != "", articles).otherwise(whole)

    return html_structured_text(let(bare, content))


def is_pdf(url: Column, content_type: Column) -> Column:
    path = F.split_part(F.lower(F.coalesce(url, F.lit(""))), F.lit("?"), F.lit(1))
    return F.coalesce(content_type, F.lit("")).contains("pdf") | path.endswith(".pdf")


def netloc(url: Column) -> Column:
    """User, host and port as they stand; empty if there is none."""
    return F.coalesce(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit(""))


def is_narrative(query: Column) -> Column:
    return query.rlike(NARRATIVE)


def embed_text(context: Column, text: Column) -> Column:
    return F.when(F.coalesce(context, F.lit("")) != "", F.concat(context, F.lit("\n"), text)).otherwise(text)


# ---- what Catalyst has no expression for ------------------------------------------------------------------------


def normalize_text(text: str | None) -> str:
    """HTML entities resolved, then NFKC."""
    return unicodedata.normalize("NFKC", html.unescape(text or ""))


def by_parts(one: Callable, kind: pa.DataType, *columns: pa.Array, rows: int = 200) -> pa.Array:
    """``one`` of each row: of a batch, which can have 64 MB, only so many rows at a time are Python's objects."""
    parts = [pa.array(map(one, *(c.slice(low, rows).to_pylist() for c in columns)), kind) for low in range(0, len(columns[0]), rows)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


@F.arrow_udf(StringType())
def _normalized(texts: pa.Array) -> pa.Array:
    return by_parts(lambda t: None if t is None else normalize_text(t), pa.string(), texts)


#: Characters that stay as they are in any text of such characters only: ASCII, Latin letters with accents, unified CJK.
STABLE = r"^[\x00-\x25\x27-\x7F\u00C0-\u0131\u0134-\u013E\u0141-\u0148\u014A-\u017E\u01A0\u01A1\u01AF\u01B0\u1EA0-\u1EF9\u3400-\u4DBF\u4E00-\u9FFF]*+$"


def normalized(text: Column) -> Column:
    """HTML entities resolved, then NFKC; null as empty. Only texts that this could change go through Python."""
    plain = F.coalesce(text, F.lit(""))
    return F.coalesce(_normalized(F.when(~plain.rlike(STABLE), plain)), plain)


def metric_normalize(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(normalized(text)), r"(?U)\s+", " "))


def metric_tokens(text: Column) -> Column:
    return F.filter(F.split(metric_normalize(text), " "), lambda w: w != "")


_DECLARED = re.compile(r"charset\s*=\s*[\"']?\s*([\w-]+)", re.I)


def decode_page(body: bytes | None, content_type: str | None = "") -> str:
    """UTF-8 if it is valid; else the declared charset, GB18030, and UTF-8 with replacements, in this order.

    The header's charset goes before one in the first 4096 bytes; the GB family is read as its superset.
    """
    body = body or b""
    if body.startswith(b"\xef\xbb\xbf"):
        return body[3:].decode("utf-8", "replace")
    declared = _DECLARED.search(content_type or "") or _DECLARED.search(body[:4096].decode("latin-1"))
    name = declared.group(1).lower() if declared else ""
    for charset in ("utf-8", "gb18030" if name in WIDENED_CHARSETS else name, "gb18030"):
        try:
            if charset:
                return body.decode(charset)
        except (LookupError, UnicodeDecodeError):
            pass
    return body.decode("utf-8", "replace")


@F.arrow_udf(StringType())
def decode_html(bodies: pa.Array, content_types: pa.Array) -> pa.Array:
    return by_parts(decode_page, pa.string(), bodies, content_types)


@F.pandas_udf(StringType())
def pdf_text(bodies: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Pages joined by blank lines; null stays null, and what can't be read is empty. Needs pypdf where there are any."""
    import io

    def read(body: bytes) -> str:
        from pypdf import PdfReader
        from pypdf.errors import PyPdfError

        try:
            return "\n\n".join(p.extract_text() or "" for p in PdfReader(io.BytesIO(body)).pages)
        except (PyPdfError, ValueError):
            return ""

    for some in bodies:
        yield some.map(read, na_action="ignore")


def lcs(a: list, b: list) -> int:
    """Longest common subsequence, bit-parallel: one big-integer step for each item of ``a``."""
    places: dict = {}
    for k, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << k
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        met = row & places.get(x, 0)
        row = ((row + met) | (row - met)) & full
    return len(b) - row.bit_count()


@F.pandas_udf(IntegerType())
def lcs_len(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([lcs(list(x) if x is not None else [], list(y) if y is not None else []) for x, y in zip(a, b, strict=True)])


def overlap(candidate: Column, gold: Column) -> Column:
    """LCS as a share of the gold tokens; 0 if there are none."""
    return F.coalesce(F.try_divide(lcs_len(candidate, gold), F.size(gold)), F.lit(0.0))


def f2(precision: Column, recall: Column) -> Column:
    return F.coalesce(F.try_divide(5 * precision * recall, 4 * precision + recall), F.lit(0.0))
