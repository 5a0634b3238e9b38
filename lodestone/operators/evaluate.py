"""Quality of answers: precision, recall and F2 of documents and passages, diversity and bias, validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULTS
from ..functions import text as T


def doc_prf(pairs: DataFrame) -> DataFrame:
    """``pairs`` (id, pred, gold: arrays of ids) with doc_p, doc_r and doc_f2; ids compare as strings."""
    sets = pairs.withColumn("_p", F.array_distinct(F.transform("pred", lambda x: x.cast("string")))).withColumn("_g", F.array_distinct(F.transform("gold", lambda x: x.cast("string"))))
    both = F.size(F.array_intersect("_p", "_g"))
    p, r = (F.coalesce(F.try_divide(both, F.size(c)), F.lit(0.0)) for c in ("_p", "_g"))
    return sets.withColumn("doc_p", p).withColumn("doc_r", r).withColumn("doc_f2", T.f2(F.col("doc_p"), F.col("doc_r"))).drop("_p", "_g")


def chunk_matches(pred: DataFrame, gold: DataFrame, threshold: float = DEFAULTS.chunk_match, tokens=T.metric_tokens) -> DataFrame:
    """(id, pred_pos, gold_pos) of passages of one document whose LCS covers ``threshold`` of the gold passage.

    Both have (id, pos, doc_id, chunk_text). Tokens are made once for each passage, before the join.
    """
    a = pred.select("id", F.col("doc_id").cast("string").alias("doc"), F.col("pos").alias("pred_pos"), tokens(F.col("chunk_text")).alias("_a"))
    b = gold.select("id", F.col("doc_id").cast("string").alias("doc"), F.col("pos").alias("gold_pos"), tokens(F.col("chunk_text")).alias("_b"))
    return a.join(b, ["id", "doc"]).where(T.overlap(F.col("_a"), F.col("_b")) >= threshold).select("id", "pred_pos", "gold_pos")


def chunk_prf(ids: DataFrame, pred: DataFrame, gold: DataFrame, threshold: float = DEFAULTS.chunk_match, tokens=T.metric_tokens) -> DataFrame:
    """(id, chunk_p, chunk_r, chunk_f2): matched submissions among all, repeats included; gold passages found among all."""
    met = chunk_matches(pred, gold, threshold, tokens).groupBy("id").agg(F.count_distinct("pred_pos").alias("mp"), F.count_distinct("gold_pos").alias("mg"))
    np_, ng = pred.groupBy("id").agg(F.count("*").alias("np")), gold.groupBy("id").agg(F.count("*").alias("ng"))
    rows = ids.select("id").distinct().join(np_, "id", "left").join(ng, "id", "left").join(met, "id", "left")
    part = lambda a, b: F.coalesce(F.try_divide(F.coalesce(F.col(a), F.lit(0)), F.col(b)), F.lit(0.0))
    rated = rows.select("id", part("mp", "np").alias("chunk_p"), part("mg", "ng").alias("chunk_r"))
    return rated.withColumn("chunk_f2", T.f2(F.col("chunk_p"), F.col("chunk_r")))


def last_per_id(answers: DataFrame, order: str | None) -> DataFrame:
    if order is None:
        return answers
    names = [c for c in answers.columns if c != "id"]
    return answers.groupBy("id").agg(F.max_by(F.struct(*names), order).alias("_r")).select("id", "_r.*")


def _passages(answers: DataFrame) -> DataFrame:
    return answers.select("id", F.posexplode("relevant_chunks").alias("pos", "c")).select("id", "pos", "c.doc_id", "c.chunk_text")


def evaluate(pred: DataFrame, gold: DataFrame, order: str | None = None, tokens=T.metric_tokens) -> DataFrame:
    """One row: n_queries and the means of all six measures over the gold queries.

    A query without prediction counts with empty lists; predictions without gold are left out; of repeated ids the last by
    ``order`` counts. Without gold all is 0.
    """
    pred, gold = last_per_id(pred, order), last_per_id(gold, order)
    none = F.array().cast("array<string>")
    asked = gold.select("id", F.col("relevant_docs").alias("gold")).join(pred.select("id", F.col("relevant_docs").cast("array<string>").alias("pred")), "id", "left")
    docs = doc_prf(asked.withColumn("pred", F.coalesce("pred", none)).withColumn("gold", F.coalesce("gold", none)))
    chunks = chunk_prf(gold, _passages(pred.join(gold.select("id"), "id", "left_semi")), _passages(gold), tokens=tokens)
    names = ["doc_p", "doc_r", "doc_f2", "chunk_p", "chunk_r", "chunk_f2"]
    return docs.join(chunks, "id").agg(F.count("*").alias("n_queries"), *[F.coalesce(F.avg(n), F.lit(0.0)).alias(n) for n in names])


def validate(answers: DataFrame, expected: DataFrame, most: int = 50) -> DataFrame:
    """(kind, id, message): missing and unexpected ids, blank passages, passages of documents not named, repeated ids."""
    have, want = answers.select("id").distinct(), expected.select("id").distinct()
    note = lambda rows, kind, message: rows.select(F.lit(kind).alias("kind"), "id", message.alias("message"))
    exploded = answers.select("id", F.transform("relevant_docs", lambda x: x.cast("string")).alias("docs"), F.explode("relevant_chunks").alias("c"))
    found = [
        note(want.join(have, "id", "left_anti"), "missing", F.lit("no record")),
        note(have.join(want, "id", "left_anti"), "unexpected", F.lit("not asked for")),
        note(exploded.where(F.trim(F.regexp_replace(F.coalesce("c.chunk_text", F.lit("")), r"(?U)\s+", " ")) == ""), "blank", F.lit("blank passage")),
        note(exploded.where(~F.array_contains("docs", F.col("c.doc_id").cast("string"))), "stray", F.concat(F.lit("passage of document "), F.col("c.doc_id").cast("string"))),
        note(answers.groupBy("id").count().where("count > 1"), "repeated", F.lit("more than one record")),
    ]
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows.orderBy("kind", "id", "message").limit(most)


def diversity(chosen: DataFrame, queries: DataFrame) -> DataFrame:
    """For each query hosts, langs, the languages' counts, whether there is one source at most, and corroborated documents.

    A query without documents is of a single source.
    """
    by_lang = chosen.groupBy("query_id", "lang").agg(F.count("*").alias("n")).groupBy("query_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("lang", "n")))).alias("lang_counts"))
    counted = chosen.groupBy("query_id").agg(
        F.count("*").alias("docs"), F.count_distinct("host").alias("hosts"), F.count_distinct("lang").alias("langs"), F.count_if(F.size("support_hosts") > 0).alias("corroborated")
    )
    rows = queries.select("query_id").join(counted, "query_id", "left").join(by_lang, "query_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return rows.select("query_id", zero("docs"), zero("hosts"), zero("langs"), "lang_counts", zero("corroborated")).withColumn("single_source", F.col("hosts") <= 1)


def entropy(rows: DataFrame, by: list[str]) -> DataFrame:
    """Shannon entropy in bits of the values of ``by`` over all rows."""
    n = rows.groupBy(*by).agg(F.count("*").alias("n"))
    share = F.col("n") / F.col("_all")
    return n.crossJoin(n.agg(F.sum("n").alias("_all"))).agg(F.coalesce(-F.sum(share * F.log2(share)), F.lit(0.0)).alias("entropy"))


def bias_report(chosen: DataFrame, top: int = 5) -> DataFrame:
    """(measure, name, value) over queries that have documents: documents a query, single-source and corroborated queries,
    shares of languages and of the most frequent hosts, entropy of hosts and languages."""
    per = chosen.groupBy("query_id").agg(F.count("*").alias("n"), F.count_distinct("host").alias("h"), F.max(F.size("support_hosts")).alias("s"))
    told = lambda measure, name, value: (F.lit(measure).alias("measure"), name.alias("name"), value.cast("double").alias("value"))
    whole = per.agg(F.count("*").alias("q"), F.avg("n").alias("d"), F.count_if(F.col("h") <= 1).alias("one"), F.count_if(F.col("s") > 0).alias("cor"))
    rows = whole.select(F.explode(F.array(*[F.struct(*told(m, F.lit(""), F.col(c))) for m, c in (("queries", "q"), ("docs_per_query", "d"), ("single_source", "one"), ("corroborated", "cor"))])).alias("x")).select("x.*")
    for column in ("lang", "host"):
        n = chosen.groupBy(column).agg(F.count("*").alias("n"))
        share = n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))))
        best = share.orderBy(F.desc("n"), column).limit(top) if column == "host" else share
        rows = rows.unionByName(best.select(*told(f"{column}_share", F.col(column), F.col("share"))))
        rows = rows.unionByName(entropy(chosen, [column]).select(*told(f"{column}_entropy", F.lit(""), F.col("entropy"))))
    return rows
