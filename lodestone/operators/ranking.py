"""From candidates to documents and passages. Everything is keyed by query_id, so all queries are ranked at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULTS
from ..functions.columns import maybe_broadcast
from ..tables import stored
from .dense import cosine


def with_chunks(candidates: DataFrame, chunks: DataFrame) -> DataFrame:
    """Candidates with their chunks' columns. Candidates are few, and written, so that they are counted: chunks aren't shuffled for them."""
    return maybe_broadcast(stored(candidates, "candidates")).join(chunks, "chunk_id")


def with_metadata(rows: DataFrame, metadata: DataFrame, clusters: DataFrame) -> DataFrame:
    """host ("?" if unknown), lang (the chunk's if unknown) and cluster (the document's own id if in none)."""
    known = metadata.select(F.col("id").alias("doc_id"), F.col("host").alias("_host"), F.col("lang").alias("_lang"))
    joined = rows.join(known, "doc_id", "left").join(clusters, "doc_id", "left")
    return (
        joined.withColumn("host", F.coalesce("_host", F.lit("?")))
        .withColumn("lang", F.coalesce("_lang", "lang"))
        .withColumn("cluster", F.coalesce("cluster_id", "doc_id"))
        .drop("_host", "_lang", "cluster_id")
    )


def rerank(candidates: DataFrame, scores: Column | None = None) -> DataFrame:
    """Candidates with ``score`` from a reranker, or their fusion score where a query's are all 0 or there is none.

    ``candidates`` has query_id, chunk_id, fusion and rank.
    """
    given = F.lit(0.0) if scores is None else F.coalesce(scores, F.lit(0.0))
    rows = candidates.withColumn("_given", given)
    silent = F.max(F.abs("_given")).over(Window.partitionBy("query_id")) == 0
    return rows.withColumn("score", F.when(silent, F.col("fusion")).otherwise(F.col("_given"))).drop("_given")


def chunk_ranks(rows: DataFrame) -> DataFrame:
    """The place of each chunk within its document: by score, then by the candidates' order."""
    order = Window.partitionBy("query_id", "doc_id").orderBy(F.desc(F.round("score", 9)), "rank")
    return rows.withColumn("place", F.row_number().over(order))


def doc_scores(ranked: DataFrame) -> DataFrame:
    """(query_id, doc_id, rel, top_score, best_chunk, lang, first_rank): the best chunk plus a tenth of the next two."""
    s, p = F.col("score"), F.col("place")
    return ranked.groupBy("query_id", "doc_id").agg(
        F.sum(F.when(p == 1, s).when(p <= 3, 0.1 * s).otherwise(0.0)).alias("rel"),
        F.max(F.when(p == 1, s)).alias("top_score"),
        F.max(F.when(p == 1, F.col("chunk_id"))).alias("best_chunk"),
        F.max(F.when(p == 1, F.col("lang"))).alias("lang"),
        F.min("rank").alias("first_rank"),
    )


def agreement(docs: DataFrame, theta: float = DEFAULTS.agree_theta, rel_min: float = DEFAULTS.agree_rel_min, similarity: DataFrame | None = None) -> DataFrame:
    """Documents with ``support_hosts``: hosts of others that say the same.

    Another document supports one of the same query if it is of another host and cluster, relevant enough compared with
    the query's best, and similar enough. ``docs`` has query_id, doc_id, rel, host, cluster and embedding, or ``similarity``
    has (query_id, a, b, cos). Candidates of one query are few, so pairs are made within a query only.
    """
    best = F.max("rel").over(Window.partitionBy("query_id"))
    able = docs.withColumn("_best", best).where(F.col("rel") >= rel_min * F.col("_best"))
    extra = [F.col("embedding").alias("_vb")] if similarity is None else []
    b = able.select("query_id", F.col("doc_id").alias("_b"), F.col("host").alias("_hb"), F.col("cluster").alias("_cb"), *extra)
    a = docs.select("query_id", F.col("doc_id").alias("_a"), F.col("host").alias("_ha"), F.col("cluster").alias("_ca"), *([F.col("embedding").alias("_va")] if similarity is None else []))
    met = a.join(b, "query_id").where("_a <> _b AND _ha <> _hb AND _ca <> _cb")
    if similarity is None:
        met = met.where(cosine(F.col("_va"), F.col("_vb")) >= theta)
    else:
        both = similarity.select("query_id", F.col("a").alias("_a"), F.col("b").alias("_b"), "cos")
        met = met.join(both, ["query_id", "_a", "_b"]).where(F.col("cos") >= theta)
    support = met.groupBy("query_id", F.col("_a").alias("doc_id")).agg(F.sort_array(F.collect_set("_hb")).alias("support_hosts"))
    return docs.join(support, ["query_id", "doc_id"], "left").withColumn("support_hosts", F.coalesce("support_hosts", F.array().cast("array<string>")))


def rescored(docs: DataFrame, alpha: float = DEFAULTS.agree_alpha) -> DataFrame:
    """``final``: the relevance, raised by the logarithm of the number of supporting hosts."""
    return docs.withColumn("final", F.col("rel") * (1 + alpha * F.log1p(F.size("support_hosts"))))


def select_docs(
    docs: DataFrame,
    doc_min: int = DEFAULTS.doc_min,
    doc_max: int = DEFAULTS.doc_max,
    threshold: float = DEFAULTS.doc_rel_threshold,
    host_cap: int = DEFAULTS.host_cap,
    dedupe_clusters: bool = False,
) -> DataFrame:
    """Documents by falling ``final`` with their ``rank``: at most ``host_cap`` of a host and ``doc_max`` in all, and after
    ``doc_min`` none below ``threshold`` times the best. A best of 0 or less makes every share 0.

    Without cluster dedup this is two ranks, the caps first. With it a document skipped for its cluster uses none of its
    host's cap and one skipped for its host doesn't mark its cluster, so what is taken depends on what was: a fold over a
    query's few candidates in order, with the documents taken so far as its state. Shares only fall along the order, so the
    threshold needs no memory.
    """
    order = [F.desc(F.round("final", 9)), "first_rank", "doc_id"]
    best = F.max("final").over(Window.partitionBy("query_id"))
    share = F.when(F.col("_best") > 0, F.col("final") / F.col("_best")).otherwise(0.0)
    rows = docs.withColumn("_best", best).withColumn("_share", share)
    if dedupe_clusters:
        names = ("doc_id", "host", "cluster")
        listed = rows.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct((-F.round("final", 9)).alias("_order"), "first_rank", *names, "_share"))).alias("_all"))

        def taken(so_far: Column, one: Column) -> Column:
            free = (F.size(F.filter(so_far, lambda t: t["host"] == one["host"])) < host_cap) & ~F.exists(so_far, lambda t: t["cluster"] == one["cluster"])
            room = (F.size(so_far) < doc_min) | ((one["_share"] >= threshold) & (F.size(so_far) < doc_max))
            return F.when(free & room, F.concat(so_far, F.array(F.struct(*[one[n].alias(n) for n in names])))).otherwise(so_far)

        nothing = F.filter(F.transform("_all", lambda x: F.struct(*[x[n].alias(n) for n in names])), lambda _: F.lit(False))
        chosen = listed.select("query_id", F.posexplode(F.aggregate("_all", nothing, taken)).alias("_place", "_one"))
        return docs.join(chosen.select("query_id", F.col("_one.doc_id").alias("doc_id"), (F.col("_place") + 1).alias("rank")), ["query_id", "doc_id"])
    of_host = F.row_number().over(Window.partitionBy("query_id", "host").orderBy(*order))
    of_query = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    kept = rows.withColumn("_of_host", of_host).where(F.col("_of_host") <= host_cap).withColumn("rank", of_query)
    kept = kept.where((F.col("rank") <= doc_max) & ((F.col("rank") <= doc_min) | (F.col("_share") >= threshold)))
    return kept.drop("_best", "_share", "_of_host")


def pick_chunks(chosen: DataFrame, ranked: DataFrame, per_doc: int = DEFAULTS.chunk_max_per_doc, threshold: float = DEFAULTS.chunk_rel_threshold, unit: str = "child") -> DataFrame:
    """The passages of chosen documents: the first ``per_doc`` with at least ``threshold`` of the document's best score.

    Returns query_id, doc_id, rank, place, chunk_id, chunk_text (the child's or, for unit ``parent``, the parent's) and
    score. A best score of 0 or less gives none.
    """
    rows = ranked.drop("rank").join(chosen.select("query_id", "doc_id", "rank", "top_score"), ["query_id", "doc_id"])
    near = (F.col("top_score") > 0) & (F.try_divide("score", "top_score") >= threshold)
    text = F.col("parent_text") if unit == "parent" else F.col("text")
    return rows.where((F.col("place") <= per_doc) & near).select("query_id", "doc_id", "rank", "place", "chunk_id", text.alias("chunk_text"), "score")


def answers(queries: DataFrame, chosen: DataFrame, passages: DataFrame) -> DataFrame:
    """Submission records: one for each query, with empty lists where nothing was found."""
    docs = chosen.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "doc_id"))).alias("d"))
    texts = passages.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "place", "doc_id", "chunk_text"))).alias("c"))
    none_docs, none_texts = F.array().cast("array<bigint>"), F.array().cast("array<struct<doc_id:bigint,chunk_text:string>>")
    rows = queries.select(F.col("id").alias("query_id")).join(docs, "query_id", "left").join(texts, "query_id", "left")
    pairs = F.transform("c", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["chunk_text"].alias("chunk_text")))
    return rows.select(F.col("query_id").alias("id"), F.coalesce(F.col("d.doc_id"), none_docs).alias("relevant_docs"), F.coalesce(pairs, none_texts).alias("relevant_chunks"))


def detail_view(chosen: DataFrame) -> DataFrame:
    """Scores to four decimals and the support, for people to look at."""
    return chosen.select("query_id", "rank", "doc_id", "host", "lang", "cluster", F.round("rel", 4).alias("rel"), F.round("final", 4).alias("final"), "support_hosts", F.size("support_hosts").alias("support"))
