import json
import threading
import unicodedata
import urllib.request
from dataclasses import replace
from http.server import ThreadingHTTPServer

import pandas as pd
import pytest
from pyspark.sql import functions as F

import lodestone.cli as cli
from lodestone.config import DEFAULTS
from lodestone.functions import text as T
from lodestone.operators import crawl, lexical
from lodestone.operators.dense import HashedEmbedder
from lodestone.operators.evaluate import validate
from lodestone.plans import corpus, retrieval
from lodestone.service import Service, handler
from lodestone.sources import writers
from lodestone.streaming import ingest

TOPICS = {"en": "heart attack risk factors include smoking and high blood pressure", "vi": "đau đầu kéo dài cần đi khám bác sĩ chuyên khoa thần kinh", "zh": "糖尿病患者需要控制血糖并定期检查眼底"}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    pages = []
    for k in range(12):
        lang = ("en", "vi", "zh")[k % 3]
        body = "".join(f"<p>{TOPICS[lang]} số {k} phần {j} {'x' * (k + 3)}.</p>" for j in range(8))
        pages.append((k, f"http://host{k % 4}/{k}", "fetched", f"<title>Page {k}</title><h1>About</h1>{body}"))
    table = spark.createDataFrame(pages, "id long, url string, status string, html string")
    docs = corpus.build_documents(table, f"{root}/docs")
    corpus.build_clusters(docs, f"{root}/clusters")
    chunks = corpus.build_chunks(docs, f"{root}/chunks")
    corpus.build_indexes(chunks, root, HashedEmbedder(64))
    (tmp_path_factory.getbasetemp() / "x").mkdir(exist_ok=True)
    return root


def test_answers_from_the_built_tables(spark, built):
    found = corpus.load_corpus(spark, built)
    queries = spark.createDataFrame([(1, "heart attack smoking"), (2, "đau đầu"), (3, "糖尿病"), (4, "zzzz")], "id long, query string")
    embedded = HashedEmbedder(64).encode_queries(retrieval.expand_queries(queries)).select("query_id", "variant", "embedding")
    answers = retrieval.build_submission(found, queries, mode="bm25").orderBy("id").collect()
    assert [len(a.relevant_docs) > 0 for a in answers] == [True, True, True, False]
    assert all(c.doc_id in a.relevant_docs and c.chunk_text for a in answers for c in a.relevant_chunks)
    hybrid = retrieval.build_submission(found, queries, mode="hybrid", embedded=embedded)
    assert validate(hybrid, queries).count() == 0 and hybrid.count() == 4
    chosen, passages = retrieval.retrieve(found, queries, mode="bm25", stratify=False, host_cap=1, unit="parent")
    assert chosen.groupBy("query_id", "host").count().where("count > 1").count() == 0 and passages.count() > 0
    reranked, _ = retrieval.retrieve(found, queries.where("id = 1"), mode="bm25", scores=lambda q, t: F.length(t).cast("double"))
    assert reranked.count() > 0
    pool = retrieval.pooled_search(found, queries.where("id = 1"), embedded=embedded.where("query_id = 1"))
    assert {m for r in pool.collect() for m in r.modes} == {"bm25", "dense", "hybrid"}
    assert retrieval.build_submission(found, queries, limit=2, mode="bm25").count() == 2


def test_tokens_are_searched_without_postings(spark, built):
    """A corpus without a stored index makes no postings of all terms."""
    chunks, docs = (spark.read.parquet(f"{built}/{name}") for name in ("chunks", "docs"))
    found = retrieval.Corpus.of(chunks, docs, spark.createDataFrame([], "doc_id long, cluster_id long"))
    variants = retrieval.expand_queries(spark.createDataFrame([(1, "heart attack smoking"), (2, "đau đầu"), (3, "糖尿病")], "id long, query string"))
    for stratify in (True, False):
        lists = [retrieval.ranked_lists(c, variants, "bm25", stratify, DEFAULTS) for c in (replace(found, postings=None, statistics=None), replace(found, tokens=None))]
        a, b = ({tuple(r) for r in x.collect()} for x in lists)
        assert a == b and a


def test_expansion_reads_what_it_can(spark):
    queries = spark.createDataFrame([(1, "q"), (2, "r")], "id long, query string")
    responses = spark.createDataFrame([(1, '{"en": "one", "zh": " ", "other": 1}'), (2, "not json"), (3, '{"en": "x"}')], "id long, response string")
    assert sorted((r.query_id, r.variant, r.text) for r in retrieval.expand_queries(queries, responses).collect()) == [(1, "en", "one"), (1, "orig", "q"), (2, "orig", "r")]


def test_stale_vectors_are_refused(spark, built, tmp_path):
    import shutil

    other = tmp_path / "stale"
    shutil.copytree(built, other)
    spark.read.parquet(f"{built}/vectors").where("doc_id > 3").write.mode("overwrite").partitionBy("lang").parquet(str(other / "vectors"))
    with pytest.raises(ValueError, match="build the indexes"):
        corpus.load_corpus(spark, str(other))


def test_service(spark, built):
    (lambda p: p.write_text(json.dumps([{"id": 1, "query": "heart"}, {"id": 2, "query": "x"}])))(__import__("pathlib").Path(built) / "dev_queries.json")
    server = ThreadingHTTPServer(("127.0.0.1", 0), handler(Service(spark, built, embedder=HashedEmbedder(64))))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"

    def call(path, body=None):
        data = None if body is None else json.dumps(body).encode()
        with urllib.request.urlopen(urllib.request.Request(base + path, data)) as answer:
            return json.loads(answer.read())

    try:
        assert call("/api/health")["docs"] == 12
        found = call("/api/search", {"query": "heart attack", "mode": "bm25", "host_cap": 1})
        assert found["docs"] and found["chunks"] and found["diversity"]["hosts"] >= 1
        assert [q["status"] for q in call("/api/queries")] == ["todo", "todo"]
        assert call("/api/label/1", {"docs": [], "chunks": [{"doc_id": 3, "chunk_text": "t"}], "status": "done"})["state"] == "gold"
        assert [q["status"] for q in call("/api/queries")] == ["done", "todo"] and call("/api/label/1")["docs"] == ["3"]
        assert call("/api/doc/3")["id"] == 3
        with pytest.raises(urllib.error.HTTPError):
            call("/api/doc/999")
    finally:
        server.shutdown()


def test_streaming_ingest_takes_each_page_once(spark, tmp_path):
    page = lambda k, t: (k, "http://h/", "fetched", "word " * 60 + str(k), t)
    write = lambda rows: spark.createDataFrame(rows, "id long, url string, status string, html string, t string").selectExpr("id", "url", "status", "html", "cast(t as timestamp) as fetched").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    write([page(1, "2024-01-01 00:00:00"), page(1, "2024-01-01 00:01:00"), (2, "u", "fetched", "short", "2024-01-01 00:00:00")])
    ingest.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    write([page(1, "2024-01-01 00:02:00"), page(3, "2024-01-01 00:03:00")])
    ingest.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out/docs")).collect()) == [1, 3]
    assert sorted((r.id, r.status) for r in spark.read.parquet(str(tmp_path / "out/log")).collect()) == [(1, "ok"), (2, "empty"), (3, "ok")]


def test_every_command_is_wired():
    parser = cli.parser()
    for command in "fetch crawl repair stats cluster chunk index rebuild bias dev-sample dev-replace label submit".split():
        assert callable(parser.parse_args([command]).run)
    assert callable(parser.parse_args(["eval", "a", "b"]).run)


def test_commands_over_the_built_tables(spark, built, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda: spark)
    spark.createDataFrame([(k, f"heart attack {k}") for k in range(6)], "id long, query string").coalesce(1).write.mode("overwrite").parquet(f"{built}/query.parquet")
    spark.createDataFrame([(1, 1, "u", "ok")], "seq long, id long, url string, status string").write.mode("overwrite").parquet(f"{built}/crawl_log")
    for command in (["stats"], ["cluster"], ["chunk"], ["dev-sample", "--n", "3"], ["repair", "--dry-run"], ["submit", "--mode", "bm25", "--out", str(tmp_path / "s.json")], ["bias", "--n", "2", "--mode", "bm25"]):
        cli.main(["--data", built, *command])
    assert len(json.loads((tmp_path / "s.json").read_text())) == 6
    cli.main(["--data", built, "eval", str(tmp_path / "s.json"), str(tmp_path / "s.json")])
    assert "n_queries" in capsys.readouterr().out


def test_pdfs_take_their_own_way(spark, monkeypatch):
    import sys
    import types

    reader = types.SimpleNamespace(PdfReader=lambda f: types.SimpleNamespace(pages=[types.SimpleNamespace(extract_text=lambda: "heart attack risk factors " * 10)]))
    fetched = spark.createDataFrame(
        [(1, "http://h/a.PDF?x=1", "fetched", "text/html", bytearray(b"%PDF-")), (2, "http://h/b", "fetched", "application/pdf", bytearray(b"%PDF-")), (3, "http://h/c", "fetched", None, bytearray("<p>".encode() + "đau đầu kéo dài ".encode() * 20)), (4, "http://h/d", "error", None, None)],
        "id long, url string, status string, content_type string, body binary",
    )
    rows = crawl.decoded(fetched.where("id > 2")).collect()
    assert all(r.pdf is None and r.html is not None for r in rows)
    monkeypatch.setitem(sys.modules, "pypdf", reader)
    monkeypatch.setitem(sys.modules, "pypdf.errors", types.SimpleNamespace(PyPdfError=RuntimeError))
    assert next(T.pdf_text.func(iter([pd.Series([b"%PDF-", None])]))).tolist() == ["heart attack risk factors " * 10, None]
    taken = fetched.withColumn("pdf", F.when(F.col("id") < 3, F.lit("heart attack risk factors " * 10))).withColumn("html", F.when(F.col("id") >= 3, F.decode("body", "UTF-8")))
    found = {r.id: (r.status, r.lang, r.title) for r in crawl.extract_pages(taken, structured=True).collect()}
    assert found == {1: ("ok", "en", ""), 2: ("ok", "en", ""), 3: ("ok", "vi", ""), 4: ("error", "other", "")}


def test_search_and_index_normalise(spark, tmp_path):
    chunks = spark.createDataFrame([("a", 1, "vi", unicodedata.normalize("NFD", "đau đầu") + " ＦＵＬＬ x&amp;y ﬁn", ""), ("b", 2, "vi", "khác", "")], "chunk_id string, doc_id long, lang string, text string, context string")
    corpus.build_indexes(chunks, str(tmp_path / "i"))
    terms = {r.term for r in spark.read.parquet(str(tmp_path / "i/lexical/postings")).collect()}
    assert {"đau", "đầu", "full", "fin", "x", "y"} <= terms and "amp" not in terms
    asked = lexical.tokenized(spark.createDataFrame([(1, "full đầu")], "query_id long, text string"))
    index, stats = (spark.read.parquet(str(tmp_path / "i/lexical" / t)) for t in ("postings", "statistics"))
    assert [r.chunk_id for r in lexical.search(asked, index, stats, 5).collect()] == ["a"]


def longest_first(query, text):
    return F.length(text).cast("double")


def test_reranking_is_done_or_refused(spark, built, tmp_path, monkeypatch):
    service = Service(spark, built, embedder=HashedEmbedder(64))
    with pytest.raises(ValueError, match="no reranker"):
        service.search("heart attack", mode="bm25", rerank=True)
    service.reranker = longest_first
    found = service.search("heart attack", mode="bm25", rerank=True)
    assert found["docs"][0]["rel"] > 20 and service.search("heart attack", mode="bm25")["docs"][0]["rel"] < 1
    monkeypatch.setattr(cli, "session", lambda: spark)
    spark.createDataFrame([(1, "heart attack")], "id long, query string").coalesce(1).write.mode("overwrite").parquet(f"{built}/query.parquet")
    out = {}
    for name, flags in (("on", []), ("off", ["--no-rerank"]), ("parent", ["--output-unit", "parent"])):
        cli.main(["--data", built, "submit", "--mode", "bm25", "--reranker", f"{__name__}:longest_first", "--out", str(tmp_path / f"{name}.json"), *flags])
        out[name] = json.loads((tmp_path / f"{name}.json").read_text())[0]
    assert out["on"]["relevant_docs"] and out["on"]["relevant_docs"] == out["parent"]["relevant_docs"] and out["off"]["relevant_docs"]


def test_a_table_takes_the_place_of_another(spark, tmp_path):
    writers.overwrite(spark.range(3), str(tmp_path / "docs"))
    writers.overwrite(spark.range(2), str(tmp_path / "new"))
    before = writers.replace_table(spark, str(tmp_path / "new"), str(tmp_path / "docs"))
    assert spark.read.parquet(str(tmp_path / "docs")).count() == 2 and spark.read.parquet(before).count() == 3 and not (tmp_path / "new").exists()


def test_vectors_are_added_and_replaced(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(r, "chunk_id string, doc_id long, embedding array<float>, lang string")
    path = str(tmp_path / "vectors")
    writers.save_vectors(rows(("a", 1, [1.0], "en"), ("b", 2, [2.0], "vi")), path)
    found = writers.upsert_vectors(rows(("b", 2, [3.0], "en"), ("c", 3, [4.0], "10")), path)
    assert sorted((r.chunk_id, r.embedding[0], r.lang) for r in found.collect()) == [("a", 1.0, "en"), ("b", 3.0, "en"), ("c", 4.0, "10")]
    assert writers.upsert_vectors(rows(), path).count() == 3


def test_short_main_text_gives_way_to_the_fallback(spark):
    body = "heart attack risk factors " * 10
    pages = spark.createDataFrame(
        [(1, "u", "fetched", f"<nav>Menu</nav><main>{body}</main>"), (2, "u", "fetched", f"<main>short</main><nav>{body}</nav>"), (3, "u", "fetched", None), (4, "u", "http_404", body)],
        "id long, url string, status string, html string",
    )
    found = {r.id: (r.status, r.extractor, "Menu" in r.text, len(r.text) > 200) for r in crawl.extract_pages(pages, structured=True).collect()}
    assert found == {1: ("ok", "structured", False, True), 2: ("ok", "fallback", False, True), 3: ("empty", "empty", False, False), 4: ("http_404", "http_404", False, False)}


def test_rebuild_makes_all_tables_anew(spark, built, tmp_path, monkeypatch):
    import shutil

    shutil.copytree(f"{built}/docs", tmp_path / "docs")
    monkeypatch.setattr(cli, "session", lambda: spark)
    cli.main(["--data", str(tmp_path), "rebuild"])
    assert corpus.load_corpus(spark, str(tmp_path)).chunks.select("doc_id").distinct().count() == 12
