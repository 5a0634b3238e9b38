"""Crawl planning and page classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.readers import first_per_key, last_status


def hash_order(seed: int, key: str) -> Column:
    """A random order that any engine can repeat."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def with_host(rows: DataFrame, url: str = "url") -> DataFrame:
    return rows.withColumn("host", T.netloc(F.col(url)))


def choose_hosts(rows: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    rows = rows.where(F.col("host").isin(*include)) if include else rows
    return rows.where(~F.col("host").isin(*exclude)) if exclude else rows


def choose_ids(rows: DataFrame, ids: list[int] | None, limit: int = 0, order: str = "id") -> DataFrame:
    """The ids wanted, then the first ``limit`` of them; 0 and None are no limit."""
    rows = rows.where(F.col("id").isin(*ids)) if ids else rows
    return rows.orderBy(order).limit(limit) if limit else rows


def sample_per_host(rows: DataFrame, n: int, seed: int = 0, key: str = "id") -> DataFrame:
    """``n`` rows of each host. The rank filter is applied before the shuffle too, so a hot host moves n rows a task."""
    place = F.row_number().over(Window.partitionBy("host").orderBy(hash_order(seed, key), key))
    return rows.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def sample_rows(rows: DataFrame, n: int, seed: int = 0, key: str = "id") -> DataFrame:
    return rows.orderBy(hash_order(seed, key), key).limit(n)


def resume(rows: DataFrame, log: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Rows not logged yet; with ``retry_failed`` also those whose last status isn't ok."""
    if not retry_failed:
        return rows.join(log.select("id"), "id", "left_anti")
    return rows.join(last_status(log).where("status = 'ok'").select("id"), "id", "left_anti")


def interleave(rows: DataFrame, order: str = "seq") -> DataFrame:
    """Rows with ``turn``: the place within the host as a share of the host's rows, so hosts take turns.

    Sort by (turn, host, ``order``). A row's place is counted in salted parts of its host: first by part, then with the
    rows of the parts before it, so that a host with most of the rows isn't ranked in one task.
    """
    span = 1 << 16
    part = F.floor(F.col(order) / span)
    split = rows.withColumn("_part", part)
    sizes = split.groupBy("host", "_part").agg(F.count("*").alias("_n"))
    parts = Window.partitionBy("host").orderBy("_part")
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(parts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("_all", F.sum("_n").over(Window.partitionBy("host")))
    place = F.row_number().over(Window.partitionBy("host", "_part").orderBy(order)) - 1
    ranked = split.join(sizes, ["host", "_part"]).withColumn("turn", (place + F.col("_before")) / F.col("_all"))
    return ranked.drop("_part", "_n", "_before", "_all")


def plan_crawl(
    links: DataFrame, log: DataFrame, limit: int = 0, retry_failed: bool = False, per_host: int = 0, hosts: list[str] | None = None, exclude: list[str] | None = None, seed: int = 0
) -> DataFrame:
    """The links to fetch now: hosts, per-host sample, limit and resume, in this order; sort by (turn, host, seq)."""
    rows = choose_hosts(with_host(links), hosts, exclude)
    rows = sample_per_host(rows, per_host, seed) if per_host else rows
    rows = sample_rows(rows, limit, seed) if limit else rows
    return interleave(resume(rows, log, retry_failed))


def throttled_start(rows: DataFrame, delay: float = 1.0) -> DataFrame:
    """With ``start_s``, the earliest second a page may be fetched if each host waits ``delay`` between pages."""
    return rows.withColumn("start_s", (F.row_number().over(Window.partitionBy("host").orderBy("turn", "id")) - 1) * F.lit(delay))


def page_status(text: Column, status: Column) -> Column:
    """The fetch's status unless it is ``fetched``; then by the text: empty, blocked, garbled or ok."""
    return (
        F.when(status != "fetched", status)
        .when(F.length(text) < 50, "empty")
        .when(T.looks_blocked(text), "blocked")
        .when(T.is_garbled(text), "garbled")
        .otherwise("ok")
    )


def decoded(fetched: DataFrame) -> DataFrame:
    """Fetched (id, url, status, content_type, body) pages with ``html``, or for PDFs ``pdf``, the other one null."""
    pdf = F.coalesce(T.is_pdf(F.col("url"), F.col("content_type")), F.lit(False))
    body = F.coalesce("body", F.lit("").cast("binary"))
    return fetched.withColumn("pdf", T.pdf_text(F.when(pdf, body))).withColumn("html", F.when(~pdf, T.decode_html(body, F.col("content_type"))))


def extract_pages(pages: DataFrame, structured: bool = False) -> DataFrame:
    """Pages (id, url, status, html) as documents with their final status; text and title are empty unless it is ok.

    ``structured`` takes a page's main content with its headings, or the fallback where that has under 200 characters.
    Where there is a column ``pdf``, its text stands for a page whose ``html`` is null. ``extractor`` tells which it was.
    """
    rows = pages.withColumn("_main", T.html_main_text(F.col("html")) if structured else F.lit(""))
    way = F.when(F.length("_main") >= 200, "structured").otherwise("fallback")
    source = F.when(F.length("_main") >= 200, F.col("_main")).otherwise(T.html_fallback_text(F.col("html")))
    if "pdf" in pages.columns:
        way = F.when(F.col("html").isNull(), "pdf").otherwise(way)
        source = F.when(F.col("html").isNull(), F.coalesce("pdf", F.lit(""))).otherwise(source)
    rows = rows.withColumn("_text", T.collapse_blank_lines(source)).withColumn("status", page_status(F.col("_text"), F.col("status")))
    ok = F.col("status") == "ok"
    only = lambda c: F.when(ok, c).otherwise(F.lit(""))
    return rows.select(
        "id",
        "url",
        "status",
        F.when(ok, T.detect_lang(F.col("_text"))).otherwise("other").alias("lang"),
        only(T.html_title(F.col("html"))).alias("title"),
        only(F.col("_text")).alias("text"),
        only(T.netloc(F.col("url"))).alias("source"),
        F.when(ok, way).otherwise(F.col("status")).alias("extractor"),
    )


def crawl_summary(log: DataFrame) -> DataFrame:
    return last_status(log).groupBy("status").agg(F.count("*").alias("n"))


def garbled_docs(docs: DataFrame) -> DataFrame:
    return docs.where(T.is_garbled(F.col("text"))).select("id", "url")


def garbled_per_host(docs: DataFrame) -> DataFrame:
    return with_host(garbled_docs(docs)).groupBy("host").agg(F.count("*").alias("n"))


def repair(docs: DataFrame, fetched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(docs with garbled ones replaced or dropped, log rows of those that couldn't be had).

    ``fetched`` is ``extract_pages`` over the garbled documents' URLs. Of an id's documents the first is repaired and
    later ones go.
    """
    docs = first_per_key(docs, ["id"], [F.col("seq").asc_nulls_last()])
    bad = garbled_docs(docs).select("id")
    good = fetched.where("status = 'ok'").drop("status").join(bad, "id", "left_semi").join(docs.select("id", "seq"), "id")
    kept = docs.join(bad, "id", "left_anti")
    failed = fetched.where("status <> 'ok'").select("id", "url", "status")
    return kept.unionByName(good.select(*kept.columns)), failed


def checked_repair(before: int, replaced: int, dropped: int, after: int) -> None:
    """Refuse a rewrite whose row counts don't add up."""
    if after != before - dropped or replaced + dropped > before:
        raise ValueError(f"{before} documents, {replaced} replaced, {dropped} dropped, but {after} written")


