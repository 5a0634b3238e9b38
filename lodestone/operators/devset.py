"""Development queries and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .crawl import hash_order


def strata(queries: DataFrame) -> DataFrame:
    """(id, query) with len_bin, the quartile of the word count, and narrative.

    Quartile edges interpolate; bins hold their right edge, the first its left one too, and equal edges are one, so equal
    lengths share a bin. The edges are one small row, exact over all queries.
    """
    rows = queries.withColumn("_n", T.word_count(F.col("query"))).withColumn("narrative", T.is_narrative(F.col("query")))
    edges = rows.agg(F.array_distinct(F.percentile("_n", F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 1.0)]))).alias("_edges"))
    inner = F.slice("_edges", F.lit(2), F.greatest(F.size("_edges") - 2, F.lit(0)))
    bin_ = F.size(F.filter(inner, lambda e: e < F.col("_n")))
    return rows.crossJoin(F.broadcast(edges)).withColumn("len_bin", bin_).drop("_n", "_edges")


def sample_queries(queries: DataFrame, n: int = 80, seed: int = 42) -> DataFrame:
    """``n`` queries in proportion to the strata (quotas round half to even), topped up or cut in hash order; by id."""
    rows = strata(queries)
    stratum = ["len_bin", "narrative"]
    sizes = rows.groupBy(*stratum).agg(F.count("*").alias("_size"))
    quotas = sizes.withColumn("_quota", F.bround(F.col("_size") * n / F.sum("_size").over(Window.partitionBy(F.lit(1)))))
    place = F.row_number().over(Window.partitionBy(*stratum).orderBy(hash_order(seed, "id"), "id"))
    # Those within their quota come first, then the others: the first n of this order are the sample, topped up or cut.
    # The strata are few, so quotas are broadcast.
    ranked = rows.withColumn("_place", place).join(F.broadcast(quotas), stratum).withColumn("_over", F.col("_place") > F.col("_quota"))
    return ranked.orderBy("_over", hash_order(seed, "id"), "id").limit(n).select("id", "query", *stratum).orderBy("id")


def replacements(queries: DataFrame, dev: DataFrame, status: DataFrame, target: int = 80, seed: int = 7) -> DataFrame:
    """Unused queries for skipped ones, of their strata as far as those have any left, so that ``target`` are usable.

    ``dev`` has id and ``status`` (id, status). Demands are drawn from the skipped queries with replacement; the k-th demand
    of a stratum takes the k-th unused query of it in hash order, those left over any other unused ones. Nothing
    skipped, nothing drawn.
    """
    rows = strata(queries)
    stratum = ["len_bin", "narrative"]
    in_dev = dev.select("id").distinct()
    skipped = in_dev.join(status.where("status = 'skip'").select("id"), "id", "left_semi")
    counts = in_dev.agg(F.count("*").alias("_dev")).crossJoin(skipped.agg(F.count("*").alias("_skipped")))
    need = counts.select((F.lit(target) - (F.col("_dev") - F.col("_skipped"))).alias("_need"), "_skipped")
    numbered = skipped.join(rows.select("id", *stratum), "id").withColumn("_k", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(hash_order(seed, "id"), "id")) - 1)
    # At most ``target`` demands, each one of the skipped.
    demands = need.where("_need > 0 AND _skipped > 0").select("_skipped", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_need") - 1)).alias("_demand"))
    wanted = demands.withColumn("_k", F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:draw:"), F.col("_demand").cast("string"))), 1, 8), 16, 10).cast("long"), F.col("_skipped"))).join(numbered.drop("id"), "_k")
    turn = wanted.withColumn("_turn", F.row_number().over(Window.partitionBy(*stratum).orderBy("_demand")))
    pool = rows.join(in_dev, "id", "left_anti").withColumn("_turn", F.row_number().over(Window.partitionBy(*stratum).orderBy(hash_order(seed, "id"), "id")))
    first = turn.join(pool.select("id", *stratum, "_turn"), [*stratum, "_turn"], "left").select("_demand", "id")
    got = first.where("id IS NOT NULL")
    # What is left over is at most ``target`` rows, so these ranks see few: the pool is cut to as many first.
    rest = first.where("id IS NULL").withColumn("_turn", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("_demand"))).select("_turn")
    spare = rows.join(in_dev, "id", "left_anti").join(got.select("id"), "id", "left_anti").orderBy(hash_order(seed, "id"), "id").limit(target)
    spare = spare.withColumn("_turn", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(hash_order(seed, "id"), "id")))
    return got.select("id").unionByName(rest.join(spare, "_turn").select("id")).join(queries, "id").select("id", "query")


def ordered_distinct(docs: Column, chunks: Column) -> Column:
    """The documents named, then those of the passages, each once, as strings."""
    named = F.transform(F.coalesce(docs, F.array().cast("array<string>")), lambda x: x.cast("string"))
    of_chunks = F.transform(F.coalesce(chunks, F.array().cast("array<struct<doc_id:string,chunk_text:string>>")), lambda c: c["doc_id"].cast("string"))
    return F.array_distinct(F.concat(named, of_chunks))


def label_state(events: DataFrame) -> DataFrame:
    """(qid, docs, chunks, state, status) after the last event of each query, in the schema ``schemas.LABEL_EVENTS``.

    state is gold (done, with documents), skipped, draft or none (nothing is kept); status is done, skip or todo.
    """
    names = ["docs", "chunks", "status"]
    last = events.groupBy("qid").agg(F.max_by(F.struct(*names), "seq").alias("e")).select("qid", "e.*")
    rows = last.withColumn("docs", ordered_distinct(F.col("docs"), F.col("chunks")))
    some = F.size("docs") > 0
    state = F.when((F.col("status") == "done") & some, "gold").when(F.col("status") == "skip", "skipped").when(some, "draft").otherwise("none")
    keeps = state.isin("gold", "draft")
    kept = rows.withColumn("state", state)
    return kept.select(
        "qid",
        F.when(keeps, F.col("docs")).otherwise(F.array().cast("array<string>")).alias("docs"),
        F.when(keeps, F.coalesce("chunks", F.array().cast("array<struct<doc_id:string,chunk_text:string>>"))).otherwise(F.array().cast("array<struct<doc_id:string,chunk_text:string>>")).alias("chunks"),
        "state",
        F.when(F.col("state") == "gold", "done").when(F.col("state") == "skipped", "skip").otherwise("todo").alias("status"),
    )


def gold_answers(state: DataFrame) -> DataFrame:
    return state.where("state = 'gold'").select(F.col("qid").alias("id"), F.col("docs").alias("relevant_docs"), F.col("chunks").alias("relevant_chunks"))


def with_status(queries: DataFrame, state: DataFrame) -> DataFrame:
    rows = queries.join(state.select(F.col("qid").alias("id"), "status"), "id", "left")
    return rows.withColumn("status", F.coalesce("status", F.lit("todo")))


def progress(queries: DataFrame, state: DataFrame) -> DataFrame:
    return with_status(queries, state).groupBy("status").agg(F.count("*").alias("n"))


def untick_doc(docs: Column, chunks: Column, doc: Column) -> tuple[Column, Column]:
    """Taking a document back takes its passages back."""
    return F.array_remove(docs, doc), F.filter(chunks, lambda c: c["doc_id"] != doc)


def pick_chunk(docs: Column, chunks: Column, chunk: Column) -> tuple[Column, Column]:
    """Picking a passage names its document; a passage is its document and exact text, once."""
    return F.array_distinct(F.concat(docs, F.array(chunk["doc_id"]))), F.array_distinct(F.concat(chunks, F.array(chunk)))


def can_finish(docs: Column) -> Column:
    return F.size(docs) > 0
