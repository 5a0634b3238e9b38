"""Commands: fetch, crawl, repair, stats, cluster, chunk, index, rebuild, bias, dev-sample, dev-replace, label, eval, submit."""

from __future__ import annotations

import argparse
import importlib
import os
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .config import DEFAULTS
from .operators import crawl, devset, evaluate
from .operators.dense import HashedEmbedder, ModelEmbedder
from .plans import corpus as C
from .plans import retrieval as R
from .sources import http, readers, writers


def session() -> SparkSession:
    return SparkSession.builder.appName("lodestone").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def cmd_fetch(spark, a):
    """List the data set's files with their sizes; downloading is left to the store's own tools."""
    readers.files(spark, a.data).show(1000, truncate=False)


def cmd_crawl(spark, a):
    links = readers.links(spark, f"{a.data}/links_corpus.parquet").withColumn("seq", F.col("id"))
    log_path = f"{a.data}/crawl_log"
    log = spark.read.parquet(log_path) if a.resume else spark.createDataFrame([], "seq long, id long, url string, status string")
    todo = crawl.plan_crawl(links, log, a.limit, a.retry_failed, a.sample_per_host, a.hosts, a.exclude_hosts)
    writers.overwrite(todo.orderBy("turn", "host", "seq").select("id", "url"), f"{a.data}/todo")
    http.register(spark)
    pages = spark.read.format("pages_http").options(links=f"{a.data}/todo", delay=DEFAULTS.host_delay_s, timeout=DEFAULTS.timeout_s).load()
    fetched = writers.overwrite(pages, f"{a.data}/fetched")
    if a.keep_raw:
        writers.raw_pages(fetched.where("body IS NOT NULL"), f"{a.data}/raw")
    rows = crawl.extract_pages(crawl.decoded(fetched), structured=True)
    writers.append(rows.where("status = 'ok'").drop("status").withColumn("seq", F.col("id")), f"{a.data}/docs")
    writers.append(rows.select(F.unix_micros(F.current_timestamp()).alias("seq"), "id", "url", "status"), log_path)


def cmd_repair(spark, a):
    docs = spark.read.parquet(f"{a.data}/docs")
    crawl.garbled_per_host(docs).orderBy(F.desc("n")).show()
    if a.dry_run:
        return
    writers.overwrite(crawl.garbled_docs(docs), f"{a.data}/todo")
    http.register(spark)
    pages = writers.overwrite(spark.read.format("pages_http").options(links=f"{a.data}/todo").load(), f"{a.data}/fetched")
    fixed, failed = crawl.repair(docs, crawl.extract_pages(crawl.decoded(pages), structured=True))
    before, bad = docs.select("id").distinct().count(), crawl.garbled_docs(docs).select("id").distinct().count()
    written = writers.overwrite(fixed, f"{a.data}/docs_repaired")
    dropped = failed.count()
    crawl.checked_repair(before, bad - dropped, dropped, written.count())
    writers.append(failed.select(F.unix_micros(F.current_timestamp()).alias("seq"), "id", "url", "status"), f"{a.data}/crawl_log")
    print("the old documents are in", writers.replace_table(spark, f"{a.data}/docs_repaired", f"{a.data}/docs"))


def cmd_stats(spark, a):
    crawl.crawl_summary(spark.read.parquet(f"{a.data}/crawl_log")).orderBy(F.desc("n")).show()


def cmd_cluster(spark, a):
    found = C.build_clusters(spark.read.parquet(f"{a.data}/docs"), f"{a.data}/clusters")
    found.agg(F.count("*").alias("docs_in_clusters"), F.count_distinct("cluster_id").alias("clusters")).show()


def cmd_chunk(spark, a):
    chunks = C.build_chunks(spark.read.parquet(f"{a.data}/docs"), f"{a.data}/chunks")
    chunks.agg(F.count_distinct("doc_id").alias("docs"), F.count("*").alias("chunks")).show()


def named(place: str):
    """What ``module:name`` names."""
    module, _, name = place.partition(":")
    return getattr(importlib.import_module(module), name)


def embedder_of(a):
    """A model loaded by ``--embedder module:function``, or the hashed stand-in."""
    return ModelEmbedder(named(a.embedder), a.query_prefix or "") if a.embedder else HashedEmbedder()


def cmd_index(spark, a):
    C.build_indexes(spark.read.parquet(f"{a.data}/chunks"), a.data, embedder_of(a))


def cmd_rebuild(spark, a):
    """Clusters, chunks and indexes of the documents as they are now."""
    for step in (cmd_cluster, cmd_chunk, cmd_index):
        step(spark, a)


def _corpus(spark, a):
    return C.load_corpus(spark, a.data)


def _options(a, queries):
    embedded = embedder_of(a).encode_queries(R.expand_queries(queries)).select("query_id", "variant", "embedding")
    settings = replace(DEFAULTS, host_cap=a.host_cap or DEFAULTS.host_cap)
    return {"mode": a.mode, "stratify": not a.no_stratify, "consensus": not a.no_consensus, "settings": settings, "embedded": embedded, "scores": named(a.reranker) if a.reranker and not a.no_rerank else None, "unit": a.output_unit}


def cmd_bias(spark, a):
    queries = crawl.sample_rows(readers.queries(spark, f"{a.data}/query.parquet"), a.n, 0)
    chosen, _ = R.retrieve(_corpus(spark, a), queries, **_options(a, queries))
    evaluate.bias_report(chosen).orderBy("measure", F.desc("value")).show(100, truncate=False)


def cmd_dev_sample(spark, a):
    rows = devset.sample_queries(readers.queries(spark, f"{a.data}/query.parquet"), a.n, a.seed)
    print(writers.json_array(rows.select("id", "query"), f"{a.data}/dev_queries.json", indent=1), "queries")


def cmd_dev_replace(spark, a):
    queries = readers.queries(spark, f"{a.data}/query.parquet")
    dev = spark.read.schema("id long, query string").option("multiLine", True).json(f"{a.data}/dev_queries.json")
    state = devset.label_state(spark.read.parquet(f"{a.data}/labels"))
    status = state.select(F.col("qid").alias("id"), "status")
    new = devset.replacements(queries, dev, status, a.target, a.seed)
    writers.json_array(dev.unionByName(new), f"{a.data}/dev_queries.json", indent=1)


def cmd_label(spark, a):
    from .service import serve

    serve(spark, a.data, a.port)


def cmd_eval(spark, a):
    evaluate.evaluate(readers.answers_json(spark, a.pred), readers.answers_json(spark, a.gold, gold=True)).show()


def cmd_submit(spark, a):
    queries = readers.queries(spark, f"{a.data}/query.parquet")
    if a.queries:
        ids = spark.read.schema("id long, query string").option("multiLine", True).json(a.queries)
        queries = queries.join(ids.select("id"), "id", "left_semi")
    answers = R.build_submission(_corpus(spark, a), queries, a.limit, **_options(a, queries))
    print(writers.submission(answers, a.out))
    if not a.limit:
        evaluate.validate(readers.answers_json(spark, a.out), queries).show(50, truncate=False)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lodestone", description=__doc__)
    top.add_argument("--data", default=os.environ.get("LODESTONE_DATA", "data"))
    sub = top.add_subparsers(dest="command", required=True)

    def command(name, run, **flags):
        p = sub.add_parser(name)
        p.set_defaults(run=run)
        for flag, options in flags.items():
            p.add_argument("--" + flag.replace("_", "-"), **options)
        return p

    flag = {"action": "store_true"}
    search = {"mode": {"default": "hybrid", "choices": ["bm25", "dense", "hybrid"]}, "no_stratify": flag, "no_consensus": flag, "host_cap": {"type": int}, "no_rerank": flag, "reranker": {"metavar": "MODULE:FUNCTION"}, "output_unit": {"default": "child", "choices": ["child", "parent"]}}
    model = {"embedder": {"metavar": "MODULE:FUNCTION"}, "query_prefix": {}}
    search |= model
    command("fetch", cmd_fetch)
    command("crawl", cmd_crawl, limit={"type": int, "default": 0}, retry_failed=flag, resume=flag, keep_raw=flag, sample_per_host={"type": int, "default": 0}, hosts={"nargs": "*"}, exclude_hosts={"nargs": "*"})
    command("repair", cmd_repair, dry_run=flag)
    command("stats", cmd_stats)
    command("cluster", cmd_cluster)
    command("chunk", cmd_chunk)
    command("index", cmd_index, **model)
    command("rebuild", cmd_rebuild, **model)
    command("bias", cmd_bias, n={"type": int, "default": 40}, **search)
    command("dev-sample", cmd_dev_sample, n={"type": int, "default": 80}, seed={"type": int, "default": 42})
    command("dev-replace", cmd_dev_replace, target={"type": int, "default": 80}, seed={"type": int, "default": 7})
    command("label", cmd_label, port={"type": int, "default": 8001})
    scored = command("eval", cmd_eval)
    scored.add_argument("pred")
    scored.add_argument("gold")
    command("submit", cmd_submit, out={"default": "submission.json"}, limit={"type": int, "default": 0}, queries={}, **search)
    return top


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    a.run(session(), a)


if __name__ == "__main__":
    main()
