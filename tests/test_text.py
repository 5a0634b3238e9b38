import tracemalloc
import unicodedata

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestone.functions import text as T


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "text, lang",
    [
        ("Bệnh nhân cần nghỉ ngơi và uống nhiều nước mỗi ngày.", "vi"), ("The patient should rest and drink water.", "en"), ("病人需要休息并多喝水。", "zh"), ("", "other"), ("  \n", "other"),
        ("123 456 !!", "other"), (None, "other"), ("ĐƯỜNG ĐI ĐÂU", "vi"), ("a" * 4000 + "水" * 4000, "en"), ("abcd水", "en"), ("abc水", "zh"),
    ],
)
def test_detect_lang(spark, text, lang):
    assert one(spark, text, T.detect_lang) == lang


def test_lexical_tokens(spark):
    assert one(spark, "Heart-attack risk", T.lexical_tokens) == ["heart", "attack", "risk", "heart_attack", "attack_risk"]
    assert one(spark, "糖尿病", T.lexical_tokens) == ["糖", "尿", "病", "糖尿", "尿病"]
    assert one(spark, "使用abc药 two words", T.lexical_tokens) == ["使", "用", "药", "使用", "用药", "two", "words", "two_words"]
    assert one(spark, "a 水 b", T.lexical_tokens) == ["a", "水", "b", "a_b"]
    assert one(spark, "x_y", T.lexical_tokens) == ["x", "y", "x_y"]
    assert one(spark, "", T.lexical_tokens) == [] and one(spark, None, T.lexical_tokens) == []
    assert one(spark, "Ａ&amp;Ｂ", lambda c: T.lexical_tokens(T.normalized(c))) == ["a", "b", "a_b"]


@pytest.mark.parametrize("text, garbled", [("", False), ("нет", True), ("plain text", False), ("�" + "a" * 9, False), ("��" + "a" * 10, True), ("a\tb\nc\rd", False), ("Bệnh 水", False), (None, False)])
def test_is_garbled(spark, text, garbled):
    assert one(spark, text, T.is_garbled) is garbled


def test_approx_tokens(spark):
    assert one(spark, "three small words", T.approx_tokens) == 3
    assert one(spark, "水火木", T.approx_tokens) == 4
    assert one(spark, "x" * 80, T.approx_tokens) == 10 and one(spark, None, T.approx_tokens) == 0


def test_metric_tokens(spark):
    assert one(spark, "  A&nbsp;B\n ﬁne &lt;x", T.metric_tokens) == ["a", "b", "fine", "<x"]


def test_pages(spark):
    page = "<head><title> T </title></head><script>var a='<b>';</script><h2>Head</h2><p>One  two</p><noscript>no</noscript>"
    assert one(spark, page, T.html_fallback_text).strip() == "T Head One two"
    assert one(spark, page, T.html_title) == "T"
    assert one(spark, page, T.html_structured_text) == "## Head\n\nOne two"
    assert one(spark, None, T.html_fallback_text) == ""


@pytest.mark.parametrize("url, host", [("http://u:p@h.org:80/x?y", "u:p@h.org:80"), ("https://H.org", "H.org"), ("nonsense", ""), (None, ""), ("http://a.b/c d", "")])
def test_netloc(spark, url, host):
    got = one(spark, url, T.netloc)
    assert got == host


def test_blocked_narrative_and_pdf(spark):
    assert one(spark, "x" * 149, T.looks_blocked) and not one(spark, "x" * 150, T.looks_blocked)
    assert one(spark, "x" * 200 + "Just a moment...", T.looks_blocked) and not one(spark, "x" * 2000 + "Just a moment...", T.looks_blocked)
    assert one(spark, "MẸ hỏi", T.is_narrative) and not one(spark, "mẹo hay", T.is_narrative)
    assert one(spark, "http://x/A.PDF?z", lambda c: T.is_pdf(c, F.lit(""))) and one(spark, "http://x", lambda c: T.is_pdf(c, F.lit("application/pdf")))


def test_decoding():
    text = "中文网页測試" * 10
    body = f'<meta charset="gb2312">{text}'.encode("gb18030")
    assert text in T.decode_page(body) and text in T.decode_page(text.encode())
    assert T.decode_page(b"\xef\xbb\xbfabc\xff") == "abc�" and T.decode_page(None) == ""
    assert T.decode_page("é".encode("cp1252") * 3 + b"\x81", "text/html; charset=latin-1") == "ééé\x81"
    assert T.decode_page(b"\xff\xff", "charset=nonsense") == "��"


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@given(st.lists(st.sampled_from("abc")), st.lists(st.sampled_from("abc")))
@settings(max_examples=200, deadline=None)
def test_lcs(a, b):
    assert T.lcs(a, b) == slow_lcs(a, b) == T.lcs(b, a) <= min(len(a), len(b))


def test_overlap_and_f2(spark):
    rows = spark.createDataFrame([(["a", "x", "c", "d"], ["a", "b", "c", "d"]), (["b", "a"], ["a", "b"]), ([], []), (None, ["a"])], "a array<string>, b array<string>")
    assert [tuple(r) for r in rows.select(T.lcs_len("a", "b"), T.overlap(F.col("a"), F.col("b"))).collect()] == [(3, 0.75), (1, 0.5), (0, 0.0), (0, 0.0)]
    pairs = spark.createDataFrame([(2 / 3, 0.5), (0.0, 0.0)], "p double, r double").select(T.f2(F.col("p"), F.col("r"))).collect()
    assert pairs[0][0] == pytest.approx(5 * (1 / 3) / (8 / 3 + 0.5)) and pairs[1][0] == 0


@given(st.text(alphabet="aﬁ&amp;; Ａé́"))
@settings(max_examples=50, deadline=None)
def test_normalize_is_stable(text):
    once = T.normalize_text(text.replace("&", ""))
    assert unicodedata.normalize("NFKC", once) == once


def test_main_text_leaves_what_surrounds_it(spark):
    page = "<head><title>t</title></head><header>Site</header><nav>Menu</nav><main><h1>Head</h1><p>Body</p><!-- no --><aside>Ad</aside></main><footer>Foot</footer>"
    assert one(spark, page, T.html_main_text) == "# Head\n\nBody"
    assert one(spark, "<p>before</p><article><p>one</p></article><ARTICLE class=x>two</ARTICLE>", T.html_main_text) == "one\n\ntwo"
    assert one(spark, "<p>all</p><form>field</form>", T.html_main_text) == "all"
    assert one(spark, None, T.html_main_text) == "" and one(spark, "", T.html_main_text) == ""


def test_functions_by_name_in_sql(spark):
    from lodestone.functions.register import register_functions

    register_functions(spark)
    row = spark.sql("SELECT normalize_text('x&amp;y ﬁn') AS a, lcs_len(array('a', 'b', 'c'), array('b', 'c', 'd')) AS b, decode_html(cast('é' AS binary), '') AS c").first()
    assert row == ("x&y fin", 2, "é")
    assert spark.sql("SELECT c.text FROM VALUES ('One. Two.') AS d(t), LATERAL chunk_document(t, '') AS c").first()[0] == "One. Two."


def test_text_functions_hold_few_rows_at_once():
    """Rows of a batch aren't Python's strings all at once."""
    pages = [f"<p>{'é&amp; ' * 200}{k}</p>" for k in range(4000)]
    bodies = [None, *(p.encode("utf-8" if k % 2 else "gb18030") for k, p in enumerate(pages))]
    for call, wanted, columns in (
        (T.decode_html.func, [T.decode_page(b, "charset=gb2312") for b in bodies], (pa.array(bodies), pa.array(["charset=gb2312"] * len(bodies)))),
        (T._normalized.func, [None, *map(T.normalize_text, pages)], (pa.array([None, *pages]),)),
    ):
        tracemalloc.start()
        found = call(*columns)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert found.to_pylist() == wanted and peak < 2e6
        assert len(call(*(c.slice(0, 0) for c in columns))) == 0
