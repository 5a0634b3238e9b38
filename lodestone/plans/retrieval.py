"""Answering a batch of queries: candidates, fusion, ranking, consensus, selection, passages, records.

One lazy plan over all queries; query_id is the first key of every step.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULTS, Settings
from ..functions.columns import maybe_broadcast
from ..operators import dense, fusion, lexical, ranking
from ..sources.readers import doc_metadata
from ..tables import stored


@dataclass(frozen=True)
class Corpus:
    """chunks (schemas.CHUNKS), docs metadata (id, url, title, lang, host), clusters (doc_id, cluster_id), and indexes.

    ``vectors`` (schemas.VECTORS) may be None for lexical search alone. With ``tokens`` (chunk_id, lang, tokens) searches go
    over them instead of postings, which would be those of all terms, made and shuffled for each search.
    """

    chunks: DataFrame
    metadata: DataFrame
    clusters: DataFrame
    postings: DataFrame
    statistics: DataFrame
    vectors: DataFrame | None = None
    words_only: bool = False
    tokens: DataFrame | None = None

    @classmethod
    def of(cls, chunks: DataFrame, docs: DataFrame, clusters: DataFrame, vectors: DataFrame | None = None, words_only: bool = False) -> Corpus:
        tokens = lexical.tokenized(chunks, words_only=words_only).select("chunk_id", "lang", "tokens")
        return cls(chunks, doc_metadata(docs), clusters, lexical.postings(tokens), lexical.statistics(tokens), vectors, words_only, tokens)

    def health(self) -> DataFrame:
        """One row: chunks, documents and vectors."""
        n = self.chunks.agg(F.count("*").alias("chunks"), F.count_distinct("doc_id").alias("docs"))
        points = F.lit(0).cast("long") if self.vectors is None else None
        return n.withColumn("points", points) if points is not None else n.crossJoin(self.vectors.agg(F.count("*").alias("points")))


def expand_queries(queries: DataFrame, responses: DataFrame | None = None) -> DataFrame:
    """(query_id, variant, text): the query as ``orig``, and what a model's JSON response (id, response) adds.

    Of the response's keys en, zh and vi_expanded those with text that isn't blank; a response that can't be read adds
    nothing.
    """
    own = queries.select(F.col("id").alias("query_id"), F.lit("orig").alias("variant"), F.col("query").alias("text"))
    if responses is None:
        return own
    known = responses.join(queries.select("id"), "id", "left_semi").withColumn("r", F.from_json("response", "en string, zh string, vi_expanded string"))
    more = known.select(F.col("id").alias("query_id"), F.explode(F.array(*[F.struct(F.lit(v).alias("variant"), F.col(f"r.{v}").alias("text")) for v in ("en", "zh", "vi_expanded")])).alias("x"))
    return own.unionByName(more.select("query_id", "x.*").where("text IS NOT NULL AND trim(text) <> ''"))


def ranked_lists(corpus: Corpus, variants: DataFrame, mode: str, stratify: bool, settings: Settings, embedded: DataFrame | None = None) -> DataFrame:
    """(query_id, lang, list_name, chunk_id, rank): one list for each variant and retriever, and, stratified, language.

    Unstratified the corpus counts as one language. ``embedded`` has (query_id, variant, embedding).
    """
    chunks_lang = F.col("lang") if stratify else F.lit("")
    found: DataFrame | None = None
    names = ["query_id", "lang", "list_name", "chunk_id", "rank"]
    # A variant of a query is a query of its own to the retrievers.
    both = F.concat_ws("\x1f", F.col("query_id").cast("string"), "variant")
    back = lambda rows, kind: rows.select(
        F.element_at(F.split("query_id", "\x1f"), 1).cast("long").alias("query_id"),
        "lang",
        F.concat(F.lit(f"{kind}:"), F.element_at(F.split("query_id", "\x1f"), 2)).alias("list_name"),
        "chunk_id",
        "rank",
    )
    if mode in ("bm25", "hybrid"):
        asked = lexical.tokenized(variants, words_only=corpus.words_only).select(both.alias("query_id"), "tokens")
        k = settings.per_stratum if stratify else settings.bm25_candidates
        if corpus.tokens is not None:
            spoken = corpus.tokens.where(F.col("lang").isin(*settings.languages)) if stratify else corpus.tokens.withColumn("lang", F.lit(""))
            hits = lexical.search_corpus(asked, spoken, k)
        elif stratify:
            index, stats = corpus.postings.where(F.col("lang").isin(*settings.languages)), corpus.statistics
        else:
            index = corpus.postings.withColumn("lang", F.lit(""))
            stats = corpus.statistics.agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("avgdl")) / F.sum("n")).alias("avgdl")).withColumn("lang", F.lit(""))
        if corpus.tokens is None:
            hits = lexical.search(asked, index, stats, k)
        found = back(hits, "bm25").select(*names)
    if mode in ("dense", "hybrid"):
        if corpus.vectors is None or embedded is None:
            raise ValueError("dense search needs vectors and embedded queries")
        k = settings.per_stratum if stratify else settings.dense_candidates
        coded = embedded.select(F.xxhash64("query_id", "variant").alias("query_id"), F.col("query_id").alias("_q"), "variant", "embedding")
        vectors = corpus.vectors.where(F.col("lang").isin(*settings.languages)) if stratify else corpus.vectors
        hits = dense.search_vectors(coded, vectors.withColumn("lang", chunks_lang), k, by=("lang",))
        named = hits.join(coded.select("query_id", "_q", "variant"), "query_id")
        own = named.select(F.col("_q").alias("query_id"), "lang", F.concat(F.lit("dense:"), "variant").alias("list_name"), "chunk_id", "rank")
        found = own if found is None else found.unionByName(own)
    if found is None:
        raise ValueError(f"unknown mode {mode}")
    return found


def candidates(corpus: Corpus, variants: DataFrame, mode: str = "hybrid", stratify: bool | None = None, settings: Settings = DEFAULTS, embedded: DataFrame | None = None) -> DataFrame:
    """(query_id, chunk_id, fusion, rank), at most ``rerank_candidates`` for a query.

    Lists of the original query weigh twice. Stratified, each language's lists are fused and cut first, then the languages
    with equal weight; languages outside the strata are never found.
    """
    stratify = settings.stratify if stratify is None else stratify
    lists = ranked_lists(corpus, variants, mode, stratify, settings, embedded)
    weight = fusion.original_doubled(F.col("list_name"))
    fused = fusion.rrf(lists, by=("query_id", "lang"), k=settings.rrf_k, weights=weight)
    if stratify:
        cut = fusion.truncated(fused, settings.per_stratum).withColumnRenamed("lang", "list_name")
        fused = fusion.rrf(cut, k=settings.rrf_k)
    return fusion.truncated(fused, settings.rerank_candidates).select("query_id", "chunk_id", F.col("score").alias("fusion"), "rank")


def scored_documents(corpus: Corpus, ranked: DataFrame, consensus: bool, settings: Settings = DEFAULTS) -> DataFrame:
    """Documents of ranked chunks with metadata, rel, support_hosts and final; without consensus final is rel."""
    docs = ranking.with_metadata(ranking.doc_scores(ranked), corpus.metadata, corpus.clusters)
    if not consensus or corpus.vectors is None:
        return docs.withColumn("support_hosts", F.array().cast("array<string>")).withColumn("final", F.col("rel"))
    best = corpus.vectors.select(F.col("chunk_id").alias("best_chunk"), "embedding")
    # At most ``rerank_candidates`` documents a query, counted: vectors aren't shuffled for them.
    agreed = ranking.agreement(maybe_broadcast(stored(docs, "scored")).join(best, "best_chunk"), settings.agree_theta, settings.agree_rel_min)
    return ranking.rescored(agreed, settings.agree_alpha)


def retrieve(
    corpus: Corpus,
    queries: DataFrame,
    mode: str = "hybrid",
    scores=None,
    stratify: bool | None = None,
    consensus: bool | None = None,
    host_cap: int | None = None,
    unit: str = "child",
    settings: Settings = DEFAULTS,
    variants: DataFrame | None = None,
    embedded: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(chosen documents, their passages) for all queries (id, query).

    ``scores`` is a reranker: a function from (query text, embed text) columns to a score column.
    """
    settings = settings if host_cap is None else replace(settings, host_cap=host_cap)
    variants = expand_queries(queries) if variants is None else variants
    found = candidates(corpus, variants, mode, stratify, settings, embedded)
    rows = ranking.with_chunks(found, corpus.chunks)
    given = None
    if scores is not None:
        from ..functions.text import embed_text

        rows = rows.join(queries.select(F.col("id").alias("query_id"), "query"), "query_id")
        given = scores(F.col("query"), embed_text(F.col("context"), F.col("text")))
    # At most ``rerank_candidates`` rows a query; documents and passages both start from them.
    ranked = stored(ranking.chunk_ranks(ranking.rerank(rows, given)), "ranked")
    docs = scored_documents(corpus, ranked, settings.consensus if consensus is None else consensus, settings)
    chosen = ranking.select_docs(docs, settings.doc_min, settings.doc_max, settings.doc_rel_threshold, settings.host_cap, settings.dedupe_clusters)
    return chosen, ranking.pick_chunks(chosen, ranked, settings.chunk_max_per_doc, settings.chunk_rel_threshold, unit)


def build_submission(corpus: Corpus, queries: DataFrame, limit: int = 0, ids: list[int] | None = None, **options) -> DataFrame:
    """A record for every query (id, query), of ``ids`` and the first ``limit`` if given."""
    from ..operators.crawl import choose_ids

    asked = choose_ids(queries, ids, limit)
    chosen, passages = retrieve(corpus, asked, **options)
    return ranking.answers(asked, chosen, passages)


def pooled_search(corpus: Corpus, queries: DataFrame, settings: Settings = DEFAULTS, embedded: DataFrame | None = None) -> DataFrame:
    """Documents to label from the modes bm25, dense and hybrid, as far as the corpus has vectors."""
    variants = expand_queries(queries)
    lists: DataFrame | None = None
    for mode in ("bm25", "dense", "hybrid") if corpus.vectors is not None else ("bm25",):
        found = candidates(corpus, variants, mode, None, settings, embedded).withColumn("mode", F.lit(mode))
        lists = found if lists is None else lists.unionByName(found)
    named = lists.join(corpus.chunks.select("chunk_id", "doc_id"), "chunk_id").select("query_id", "mode", "doc_id", "chunk_id", "rank")
    return fusion.pooled(named, settings.pool_depth, settings.pool_docs, settings.chunk_max_per_doc, settings.rrf_k)
