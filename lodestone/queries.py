"""The registered queries: every operator over the whole of its tables.

Stand-ins: ``documents.source`` for hosts, ``events`` for logs (user_id as id, event_type as status, event_id as seq),
``benchmark`` for queries, lines of documents for passages, ``embeddings`` for vectors (label as language).
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import text as T
from .functions.chunks import SENTENCE_END, chunk_documents, sections
from .functions.columns import let, maybe_broadcast, strip, view
from .operators import clean, crawl, dedup, dense, devset, evaluate, fusion, lexical, ranking
from .plans import retrieval
from .sources import readers
from .tables import stored

STRATA = ("en", "fr", "de", "es")
DENSE_LABELS = (0, 1, 2, 3, 4)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "documents")


def _hosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select(F.col("doc_id").alias("id"), F.col("source").alias("host"), "text", "lang")


def _text(column: str, name: str = "text_md5"):
    return F.md5(F.col(column)).alias(name)


# ---- scalar functions -------------------------------------------------------------------------------------------


def detect_lang(spark, d):
    return _docs(spark, d).select("doc_id", T.detect_lang(F.col("text")).alias("detected"))


def approx_tokens(spark, d):
    return _docs(spark, d).select("doc_id", T.approx_tokens(F.col("text")).cast("long").alias("tokens"))


def is_garbled(spark, d):
    return _docs(spark, d).select("doc_id", T.is_garbled(F.col("text")).alias("garbled"))


def lexical_tokens(spark, d):
    tokens = let(T.lexical_tokens(F.col("text")), lambda t: F.struct(F.size(t).cast("long").alias("n"), F.md5(F.array_join(t, " ")).alias("tokens_md5")))
    return _docs(spark, d).select("doc_id", tokens.alias("t")).select("doc_id", "t.*")


def sentence_split(spark, d):
    parts = F.filter(F.transform(F.split("text", SENTENCE_END), strip), lambda s: s != "")
    return _docs(spark, d).select("doc_id", let(parts, lambda p: F.struct(F.size(p).cast("long").alias("n"), F.md5(F.array_join(p, "\n")).alias("sentences_md5"))).alias("p")).select("doc_id", "p.*")


def line_split(spark, d):
    lines = F.split("text", "\n")
    return _docs(spark, d).select("doc_id", F.size(lines).cast("long").alias("n"), F.size(F.filter(lines, lambda x: strip(x) == "")).cast("long").alias("blank"))


def metric_tokens(spark, d):
    return view(spark, d, "pages").select("page_id", F.size(T.metric_tokens(F.col("html"))).cast("long").alias("n"))


def url_host(spark, d):
    return view(spark, d, "pages").select("page_id", T.netloc(F.col("url")).alias("host"))


def narrative(spark, d):
    return view(spark, d, "conversations").select("conv_id", "turn", T.is_narrative(F.col("text")).alias("narrative"), T.word_count(F.col("text")).cast("long").alias("words"))


def html_fallback_text(spark, d):
    return view(spark, d, "pages").select("page_id", T.html_fallback_text(F.col("html")).alias("t")).select("page_id", F.length("t").cast("long").alias("n_chars"), _text("t"))


def html_title(spark, d):
    return view(spark, d, "pages").select("page_id", T.html_title(F.col("html")).alias("title"))


def embed_text(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(T.embed_text(F.col("source"), F.col("text"))).alias("embed_md5"))


def pdf_dispatch(spark, d):
    return view(spark, d, "pages").select("page_id", T.is_pdf(F.col("url"), F.lit("text/html")).alias("pdf"))


def decode_html(spark, d):
    """Pages as UTF-8, as GB18030 that is declared as its subset, and as GB18030 that nothing declares, decoded again."""

    @F.arrow_udf("binary")
    def encoded(texts: pa.Array, kinds: pa.Array) -> pa.Array:
        return T.by_parts(lambda t, k: t.encode("utf-8" if k == 0 else "gb18030"), pa.binary(), texts, kinds)

    kind = F.col("page_id") % 3
    body, declared = encoded("html", kind), F.when(kind == 1, "text/html; charset=gb2312").otherwise("text/html")
    return view(spark, d, "pages").select("page_id", F.md5(T.decode_html(body, declared)).alias("text_md5"))


# ---- corpus half ------------------------------------------------------------------------------------------------


def query_scan(spark, d):
    return view(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("query")).select("id", F.length("query").cast("long").alias("n_chars"))


def boilerplate_lines(spark, d):
    return clean.boilerplate_lines(_hosted(spark, d))


def clean_docs(spark, d):
    return clean.clean_docs(_hosted(spark, d)).select(F.col("id").alias("doc_id"), F.length("text").cast("long").alias("n_chars"), _text("text"))


def _log(spark, d):
    return view(spark, d, "events").select(F.col("event_id").alias("seq"), F.col("user_id").alias("id"), F.col("event_type").alias("status"), "value")


def first_record_per_id(spark, d):
    return readers.first_per_key(_log(spark, d), ["id"], ["seq"]).select("id", "seq", "status")


def last_status_per_id(spark, d):
    return readers.last_status(_log(spark, d))


def crawl_summary(spark, d):
    return crawl.crawl_summary(_log(spark, d))


def _universe(spark, d):
    return view(spark, d, "customer").select(F.col("c_custkey").cast("long").alias("id"), F.col("c_mktsegment").alias("host"))


def resume_todo(spark, d):
    return crawl.resume(_universe(spark, d), _log(spark, d)).select("id")


def resume_retry(spark, d):
    log = _log(spark, d).withColumn("status", F.when(F.col("status") == "view", "ok").otherwise(F.col("status")))
    return crawl.resume(_universe(spark, d), log, retry_failed=True).select("id")


def host_filter(spark, d):
    return crawl.choose_hosts(_universe(spark, d), include=["BUILDING", "MACHINERY"], exclude=["MACHINERY"]).select("id")


def _links(spark, d):
    return crawl.with_host(view(spark, d, "pages").select(F.col("page_id").alias("id"), "url", F.col("page_id").alias("seq")))


def interleave_hosts(spark, d):
    return crawl.interleave(_links(spark, d)).select("id", "host", F.round("turn", 9).alias("turn"))


def sample_per_host(spark, d):
    return crawl.sample_per_host(_links(spark, d), 3).select("id", "host")


def sample_links(spark, d):
    return crawl.sample_rows(_links(spark, d), 50, 1).select("id")


def throttle_plan(spark, d):
    return crawl.throttled_start(crawl.interleave(_links(spark, d))).select("id", "start_s")


def classify_page(spark, d):
    pages = view(spark, d, "pages").select(F.col("page_id").alias("id"), "url", F.lit("fetched").alias("status"), "html")
    return crawl.extract_pages(pages).select("id", "status", "lang", F.length("text").cast("long").alias("n_chars"))


def garbled_per_host(spark, d):
    """German documents begin with characters that couldn't be read."""
    text = F.when(F.col("lang") == "de", F.concat(F.lit("\ufffd" * 400), "text")).otherwise(F.col("text"))
    return crawl.garbled_per_host(_docs(spark, d).select(F.col("doc_id").alias("id"), F.concat(F.lit("http://"), "source", F.lit("/")).alias("url"), text.alias("text")))


def repair_overlay(spark, d):
    """Documents of the first language are taken as garbled, and fetched again except those of one source."""
    docs = _docs(spark, d).select(F.col("doc_id").alias("id"), "source", F.when(F.col("lang") == "de", F.lit("�" * 60)).otherwise(F.col("text")).alias("text"), F.col("doc_id").alias("seq"), F.lit("u").alias("url"))
    ok = F.col("source") != "src1"
    fetched = _docs(spark, d).where("lang = 'de'").select(F.col("doc_id").alias("id"), F.lit("u").alias("url"), F.when(ok, "ok").otherwise("empty").alias("status"), "source", "text")
    kept, _ = crawl.repair(docs, fetched)
    return kept.select("id", _text("text"))


def page_sections(spark, d):
    def run(frames):
        for frame in frames:
            rows = [(i, k, c, len(b)) for i, title, text in frame.itertuples(index=False) for k, (c, b) in enumerate(sections(text, title))]
            yield pd.DataFrame(rows, columns=["page_id", "ordinal", "context", "n_chars"])

    pages = view(spark, d, "pages").select("page_id", T.html_title(F.col("html")).alias("title"), T.html_structured_text(F.col("html")).alias("text"))
    return pages.mapInPandas(run, "page_id long, ordinal int, context string, n_chars long")


def chunk_windows(spark, d):
    docs = _docs(spark, d).select(F.col("doc_id").alias("id"), F.lit("").alias("title"), "text", "lang")
    return chunk_documents(docs).select("chunk_id", "doc_id", "ordinal", "lang", _text("text"), _text("parent_text", "parent_md5"))


# ---- near duplicates --------------------------------------------------------------------------------------------


def _signatures(spark, d):
    return dedup.signatures(_docs(spark, d).select("doc_id", "text"))


def simhash(spark, d):
    high, low = F.shiftrightunsigned("sig", 32), F.col("sig").bitwiseAND(F.lit(0xFFFFFFFF))
    return _signatures(spark, d).select("doc_id", high.alias("sig_high"), low.alias("sig_low"))


def lsh_pairs(spark, d):
    return dedup.lsh_pairs(_signatures(spark, d)).select("a", "b", F.col("distance").cast("long").alias("distance"))


def dup_clusters(spark, d):
    clean_ = clean.clean_docs(_hosted(spark, d)).select(F.col("id").alias("doc_id"), "text")
    return dedup.cluster(dedup.signatures(clean_))


def cluster_counts(spark, d):
    clean_ = clean.clean_docs(_hosted(spark, d)).select(F.col("id").alias("doc_id"), "text")
    return dedup.build_clusters(clean_)[1]


# ---- retrieval --------------------------------------------------------------------------------------------------


def _passages(spark, d):
    """Lines of documents: (chunk_id, doc_id, ordinal, text, lang); blank lines are none."""
    rows = _docs(spark, d).select("doc_id", "lang", F.posexplode(F.split("text", "\n")).alias("ordinal", "text"))
    named = rows.where(strip(F.col("text")) != "").withColumn("chunk_id", F.concat_ws(":", F.col("doc_id").cast("string"), F.col("ordinal").cast("string")))
    return named.select("chunk_id", "doc_id", "ordinal", "text", F.lit("").alias("context"), F.col("text").alias("parent_text"), "lang")


def _asked(spark, d, words_only=True):
    rows = view(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return lexical.tokenized(rows, words_only=words_only).select("query_id", "tokens")


def _doc_tokens(spark, d, words_only=True, by_lang=False):
    rows = _docs(spark, d).select(F.col("doc_id").alias("chunk_id"), F.col("lang") if by_lang else F.lit("").alias("lang"), "text")
    return lexical.tokenized(rows, words_only=words_only).select("chunk_id", "lang", "tokens")


def bm25_topk(spark, d):
    found = lexical.search_corpus(_asked(spark, d, False), _doc_tokens(spark, d, False), 10)
    return found.select("query_id", F.col("chunk_id").alias("doc_id"), F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


def bm25_by_lang(spark, d):
    found = lexical.search_corpus(_asked(spark, d), _doc_tokens(spark, d, by_lang=True), 5)
    return found.select("query_id", "lang", F.col("chunk_id").alias("doc_id"), F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


def bm25_statistics(spark, d):
    return lexical.statistics(_doc_tokens(spark, d, by_lang=True)).select("lang", "n", F.round("avgdl", 6).alias("avgdl"))


def _vectors(spark, d):
    return view(spark, d, "embeddings").select(F.col("vec_id").alias("chunk_id"), F.col("label").cast("string").alias("lang"), "embedding")


def _vector_queries(spark, d):
    """The stated query set: ids divisible by 100, against all vectors."""
    return view(spark, d, "embeddings").where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


def _dense(found):
    return found.select("query_id", F.col("chunk_id").alias("vec_id"), F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


def dense_topk(spark, d):
    return _dense(dense.search_vectors(_vector_queries(spark, d), _vectors(spark, d), 10))


def dense_topk_filtered(spark, d):
    return _dense(dense.search_vectors(_vector_queries(spark, d), _vectors(spark, d), 10, langs=[str(x) for x in DENSE_LABELS]))


def vector_lookup(spark, d):
    wanted = _vector_queries(spark, d).select(F.col("query_id").alias("chunk_id"), F.row_number().over(Window.orderBy(F.desc("query_id"))).alias("position"))
    return readers.vectors_in_order(_vectors(spark, d), wanted).select("position", "chunk_id", F.round(dense.norm(F.col("embedding")), 5).alias("length"))


def index_mismatch(spark, d):
    chunks = _docs(spark, d).select(F.col("doc_id").alias("chunk_id"))
    return readers.index_mismatch(chunks, _vectors(spark, d))


def _two_lists(spark, d):
    index, words = _doc_tokens(spark, d, False), _doc_tokens(spark, d)
    both = lexical.search_corpus(_asked(spark, d, False), index, 30).withColumn("list_name", F.lit("bm25:orig"))
    return both.unionByName(lexical.search_corpus(_asked(spark, d), words, 30).withColumn("list_name", F.lit("bm25:words"))).select("query_id", "list_name", "chunk_id", "rank")


def rrf_fusion(spark, d):
    found = fusion.truncated(fusion.rrf(_two_lists(spark, d), weights=fusion.original_doubled(F.col("list_name"))), 20)
    return found.select("query_id", F.col("chunk_id").alias("doc_id"), F.col("rank").cast("long").alias("rank"), F.round("score", 9).alias("score"))


def stratified_fusion(spark, d):
    lists = lexical.search_corpus(_asked(spark, d), _doc_tokens(spark, d, by_lang=True), 30).withColumn("list_name", F.col("lang"))
    found = fusion.truncated(fusion.rrf(lists.select("query_id", "list_name", "chunk_id", "rank")), 60)
    return found.select("query_id", F.col("chunk_id").alias("doc_id"), F.col("rank").cast("long").alias("rank"), F.round("score", 9).alias("score"))


def _ranked(spark, d):
    """Lines ranked for every benchmark text: candidates, fusion, chunk ranks."""
    passages = _passages(spark, d)
    index = lexical.tokenized(passages.withColumn("lang", F.lit("")), words_only=True).select("chunk_id", "lang", "tokens")
    lists = lexical.search_corpus(_asked(spark, d), index, 60).select("query_id", F.lit("bm25:orig").alias("list_name"), "chunk_id", "rank")
    fused = fusion.rrf(lists).select("query_id", "chunk_id", F.col("score").alias("fusion"), "rank")
    return stored(ranking.chunk_ranks(ranking.rerank(ranking.with_chunks(fused, passages))), "ranked")


def _documents(spark, d, ranked=None, clusters=None):
    """Scored documents with metadata and, for consensus, the vector whose id is the document's modulo the vectors."""
    meta = _docs(spark, d).select(F.col("doc_id").alias("id"), F.col("source").alias("host"), "lang")
    none = spark.createDataFrame([], "doc_id long, cluster_id long")
    docs = ranking.with_metadata(ranking.doc_scores(_ranked(spark, d) if ranked is None else ranked), meta, none if clusters is None else clusters)
    vectors = view(spark, d, "embeddings")
    n = vectors.agg(F.count("*").alias("n"))
    at = docs.crossJoin(F.broadcast(n)).withColumn("vec_id", F.col("doc_id") % F.col("n"))
    return ranking.rescored(ranking.agreement(at.join(vectors.select("vec_id", "embedding"), "vec_id"), theta=0.2))


def doc_scores(spark, d):
    found = ranking.doc_scores(_ranked(spark, d))
    return found.select("query_id", "doc_id", F.round("rel", 6).alias("rel"), F.round("top_score", 6).alias("top_score"), "best_chunk", F.col("first_rank").cast("long").alias("first_rank"))


def agreement_rescore(spark, d):
    return _documents(spark, d).select("query_id", "doc_id", F.size("support_hosts").cast("long").alias("support"), F.array_join("support_hosts", ",").alias("hosts"), F.round("final", 6).alias("final"))


def _chosen(spark, d, dedupe=False, ranked=None):
    # Every other document is in one of three clusters, the rest in none.
    clusters = _docs(spark, d).where("doc_id % 2 = 0").select("doc_id", (F.col("doc_id") % 6).alias("cluster_id")) if dedupe else None
    docs = _documents(spark, d, ranked, clusters)
    return stored(ranking.select_docs(docs, dedupe_clusters=dedupe).drop("embedding"), "chosen")


def select_docs(spark, d):
    return _chosen(spark, d).select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"))


def select_docs_dedupe(spark, d):
    return _chosen(spark, d, True).select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"))


def pick_chunks(spark, d):
    ranked = _ranked(spark, d)
    found = ranking.pick_chunks(_chosen(spark, d, ranked=ranked), ranked)
    return found.select("query_id", "doc_id", F.col("place").cast("long").alias("place"), "chunk_id", F.md5("chunk_text").alias("text_md5"))


def _answers(spark, d):
    ranked = _ranked(spark, d)
    chosen = _chosen(spark, d, ranked=ranked)
    return ranking.answers(view(spark, d, "benchmark").select(F.col("item_id").alias("id")), chosen, ranking.pick_chunks(chosen, ranked))


def submission_rows(spark, d):
    docs = F.array_join(F.transform("relevant_docs", lambda x: x.cast("string")), ",")
    return _answers(spark, d).select("id", docs.alias("docs"), F.size("relevant_chunks").cast("long").alias("chunks"))


def validate_submission(spark, d):
    """Answers against the ids of documents, so that there is something to complain about."""
    return evaluate.validate(_answers(spark, d), _docs(spark, d).select(F.col("doc_id").alias("id")))


def diversity(spark, d):
    asked = view(spark, d, "benchmark").select(F.col("item_id").alias("query_id"))
    return evaluate.diversity(_chosen(spark, d), asked).drop("lang_counts")


def bias_report(spark, d):
    return evaluate.bias_report(_chosen(spark, d)).withColumn("value", F.round("value", 6))


def _gold(spark, d):
    """(id, docs): documents that contain the benchmark text. The benchmark is the query set; its size is checked."""
    asked = maybe_broadcast(view(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("passage")))
    return stored(_docs(spark, d).join(asked, F.contains("text", "passage")).select("id", "doc_id", "passage"), "gold")


def doc_prf(spark, d):
    gold = _gold(spark, d).groupBy("id").agg(F.collect_set("doc_id").alias("gold"))
    pred = _chosen(spark, d).groupBy(F.col("query_id").alias("id")).agg(F.collect_set("doc_id").alias("pred"))
    rows = gold.join(pred, "id", "left").withColumn("pred", F.coalesce("pred", F.array().cast("array<bigint>")))
    return evaluate.doc_prf(rows).select("id", *[F.round(c, 6).alias(c) for c in ("doc_p", "doc_r", "doc_f2")])


def chunk_prf(spark, d):
    gold = _gold(spark, d)
    due = gold.select("id", "doc_id", F.col("passage").alias("chunk_text")).withColumn("pos", F.monotonically_increasing_id())
    answers = _answers(spark, d).join(gold.select("id").distinct(), "id", "left_semi")
    sent = answers.select("id", F.posexplode("relevant_chunks").alias("pos", "c")).select("id", "pos", "c.doc_id", "c.chunk_text")
    found = evaluate.chunk_prf(gold, sent, stored(due, "due"))
    return found.select("id", *[F.round(c, 6).alias(c) for c in ("chunk_p", "chunk_r", "chunk_f2")])


def evaluate_macro(spark, d):
    texts = F.collect_list(F.struct(F.col("doc_id").cast("string").alias("doc_id"), F.col("passage").alias("chunk_text")))
    gold = _gold(spark, d).groupBy("id").agg(F.sort_array(F.collect_list(F.col("doc_id").cast("string"))).alias("relevant_docs"), texts.alias("relevant_chunks"))
    found = evaluate.evaluate(_answers(spark, d), gold)
    return found.select("n_queries", *[F.round(c, 6).alias(c) for c in found.columns[1:]])


def lcs_overlap(spark, d):
    """Every benchmark text against the next one."""
    rows = view(spark, d, "benchmark").select("item_id", T.metric_tokens(F.col("text")).alias("a"))
    after = rows.select((F.col("item_id") - 1).alias("item_id"), F.col("a").alias("b"))
    return rows.join(after, "item_id").select("item_id", T.lcs_len(F.col("a"), F.col("b")).cast("long").alias("lcs"), F.round(T.overlap(F.col("a"), F.col("b")), 6).alias("share"))


# ---- development queries and labels -----------------------------------------------------------------------------


def _pool(spark, d):
    return view(spark, d, "conversations").where("role = 'user'").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text").alias("query"))


def query_strata(spark, d):
    return devset.strata(_pool(spark, d)).select("id", F.col("len_bin").cast("long").alias("len_bin"), "narrative")


def dev_sample(spark, d):
    return devset.sample_queries(_pool(spark, d)).select("id")


def dev_replacements(spark, d):
    dev = devset.sample_queries(_pool(spark, d)).select("id")
    status = dev.withColumn("status", F.when(F.col("id") % 3 == 0, "skip").otherwise("todo"))
    return devset.replacements(_pool(spark, d), dev, status).select("id")


def _label_events(spark, d):
    kind = F.col("event_type")
    status = F.when(kind == "purchase", "done").when(kind == "error", "skip").otherwise("todo")
    some = F.array(F.col("value").cast("int").cast("string"), (F.col("event_id") % 7).cast("string"), F.col("value").cast("int").cast("string"))
    docs = F.when(kind == "signup", F.array().cast("array<string>")).otherwise(some)
    chunks = F.when(kind == "click", F.array(F.struct((F.col("event_id") % 5).cast("string").alias("doc_id"), F.lit("x").alias("chunk_text")))).otherwise(F.array().cast("array<struct<doc_id:string,chunk_text:string>>"))
    return view(spark, d, "events").select(F.col("event_id").alias("seq"), F.col("user_id").alias("qid"), docs.alias("docs"), chunks.alias("chunks"), status.alias("status"))


def label_state(spark, d):
    found = devset.label_state(_label_events(spark, d))
    return found.select("qid", F.array_join("docs", ",").alias("docs"), F.size("chunks").cast("long").alias("chunks"), "state", "status")


def label_progress(spark, d):
    asked = view(spark, d, "customer").select(F.col("c_custkey").cast("long").alias("id"))
    return devset.progress(asked, devset.label_state(_label_events(spark, d)))


def pooled_search(spark, d):
    passages = _passages(spark, d).select("chunk_id", "doc_id")
    modes = None
    for name, words in (("bm25", False), ("words", True)):
        index = lexical.tokenized(_passages(spark, d).withColumn("lang", F.lit("")), words_only=words).select("chunk_id", "lang", "tokens")
        found = lexical.search_corpus(_asked(spark, d, words), index, 40).withColumn("mode", F.lit(name))
        modes = found if modes is None else modes.unionByName(found)
    lists = ranking.with_chunks(modes, passages).select("query_id", "mode", "doc_id", "chunk_id", "rank")
    found = fusion.pooled(stored(lists, "pooled"))
    names = ("doc_rank", "chunk_rank")
    return found.select("query_id", "doc_id", "chunk_id", F.array_join("modes", ",").alias("modes"), *[F.col(c).cast("long").alias(c) for c in names], F.round("doc_score", 9).alias("doc_score"), F.round("chunk_score", 9).alias("chunk_score"))


def hybrid_answers(spark, d):
    """Chunks of documents by BM25 and hashed embeddings, stratified by language, fused, agreed on, selected."""
    from dataclasses import replace

    from .config import DEFAULTS

    docs = _docs(spark, d).select(F.col("doc_id").alias("id"), F.concat(F.lit("http://"), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("url"), "lang", F.lit("").alias("title"), "text", "source", F.col("doc_id").alias("seq"))
    # Answers are chunks; their surroundings, several times the text, aren't asked for.
    chunks = stored(chunk_documents(docs).drop("parent_text"), "chunks")
    embedder = dense.HashedEmbedder(64)
    vectors = stored(embedder.encode_docs(chunks).select("chunk_id", "doc_id", "lang", "embedding"), "vectors")
    corpus = retrieval.Corpus.of(chunks, docs, spark.createDataFrame([], "doc_id long, cluster_id long"), vectors)
    queries = view(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("query"))
    embedded = embedder.encode_queries(retrieval.expand_queries(queries)).select("query_id", "variant", "embedding")
    chosen, _ = retrieval.retrieve(corpus, queries, settings=replace(DEFAULTS, languages=STRATA), embedded=embedded)
    return chosen.select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"), "host", "lang", F.size("support_hosts").cast("long").alias("support"))


def doc_lookup(spark, d):
    docs = _docs(spark, d).withColumnRenamed("doc_id", "id")
    return readers.docs_by_id(docs, [3, 5, 8]).select("id", "lang", _text("text"))


def corpus_health(spark, d):
    vectors = view(spark, d, "embeddings")
    return _passages(spark, d).agg(F.count("*").alias("chunks"), F.count_distinct("doc_id").alias("docs")).crossJoin(vectors.agg(F.count("*").alias("points")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        detect_lang, approx_tokens, is_garbled, lexical_tokens, sentence_split, line_split, metric_tokens, url_host, narrative, html_fallback_text, html_title,
        embed_text, pdf_dispatch, decode_html, query_scan, boilerplate_lines, clean_docs, first_record_per_id, last_status_per_id, crawl_summary,
        resume_todo, resume_retry, host_filter, interleave_hosts, sample_per_host, sample_links, throttle_plan, classify_page, garbled_per_host,
        repair_overlay, page_sections, chunk_windows, simhash, lsh_pairs, dup_clusters, cluster_counts, bm25_topk, bm25_by_lang, bm25_statistics,
        dense_topk, dense_topk_filtered, vector_lookup, index_mismatch, rrf_fusion, stratified_fusion, doc_scores, agreement_rescore, select_docs,
        select_docs_dedupe, pick_chunks, submission_rows, validate_submission, diversity, bias_report, doc_prf, chunk_prf, evaluate_macro, lcs_overlap,
        query_strata, dev_sample, dev_replacements, label_state, label_progress, pooled_search, hybrid_answers, doc_lookup, corpus_health,
    )
}
