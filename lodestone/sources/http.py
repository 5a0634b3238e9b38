"""A Python data source that fetches pages: spark.read.format("pages_http").option("links", path).

Pages of a host go to one partition, where they are spaced by ``delay``; robots.txt is asked once for each origin. It needs
a network; everything that follows reads its rows from a table.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
import urllib.robotparser
from collections.abc import Iterator
from urllib.parse import urlsplit

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "id long, url string, status string, content_type string, body binary"
RETRIED = (429, 500, 502, 503, 504)


class Throttle:
    """At least ``delay`` seconds between requests to one host."""

    def __init__(self, delay: float, clock=time.monotonic, sleep=time.sleep):
        self.delay, self.clock, self.sleep, self.free = delay, clock, sleep, {}

    def wait(self, host: str) -> None:
        now = self.clock()
        at = max(now, self.free.get(host, now))
        self.free[host] = at + self.delay
        if at > now:
            self.sleep(at - now)


class Robots:
    """robots.txt of each origin, asked once; where it can't be had everything is allowed."""

    def __init__(self, agent: str, fetch):
        self.agent, self.fetch, self.known = agent, fetch, {}

    def allow(self, url: str) -> bool:
        parts = urlsplit(url)
        origin = f"{parts.scheme}://{parts.netloc}"
        if origin not in self.known:
            try:
                rules = urllib.robotparser.RobotFileParser()
                rules.parse(self.fetch(f"{origin}/robots.txt")[1].decode("utf-8", "replace").splitlines())
                self.known[origin] = rules
            except Exception:  # noqa: BLE001 - whatever went wrong, nothing is forbidden
                self.known[origin] = None
        rules = self.known[origin]
        return rules is None or rules.can_fetch(self.agent, url)


def fetch(url: str, timeout: float = 30, agent: str = "lodestone", tries: int = 3, backoff: float = 2, sleep=time.sleep) -> tuple[str, bytes]:
    """(content type, body); retried on 429 and server errors, after Retry-After if there is one."""
    for k in range(tries + 1):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": agent}), timeout=timeout) as answer:
                return answer.headers.get("Content-Type", ""), answer.read()
        except urllib.error.HTTPError as error:
            if error.code not in RETRIED or k == tries:
                raise
            after = error.headers.get("Retry-After", "")
            sleep(float(after) if after.isdigit() else backoff * 2**k)
    raise AssertionError


class _Hosts(InputPartition):
    def __init__(self, rows: list[tuple[int, str]]):
        self.rows = rows


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        links = SparkSession.active().read.parquet(self.options["links"]).select("id", "url")
        n = int(self.options.get("partitions", "16"))
        parts: list[list[tuple[int, str]]] = [[] for _ in range(n)]
        # The plan of one crawl run: as many links as are to be fetched now.
        for row in links.toLocalIterator():
            parts[hash(urlsplit(row["url"] or "").netloc) % n].append((row["id"], row["url"]))
        return [_Hosts(p) for p in parts if p]

    def read(self, partition: _Hosts) -> Iterator[tuple]:
        timeout, agent = float(self.options.get("timeout", "30")), self.options.get("agent", "lodestone")
        get = lambda url: fetch(url, timeout, agent)
        throttle, robots = Throttle(float(self.options.get("delay", "1"))), Robots(agent, get)
        for id_, url in partition.rows:
            try:
                if self.options.get("robots", "true") == "true" and not robots.allow(url):
                    yield id_, url, "robots", "", None
                    continue
                throttle.wait(urlsplit(url).netloc)
                kind, body = get(url)
                yield id_, url, "fetched", kind, body
            except urllib.error.HTTPError as error:
                yield id_, url, f"http_{error.code}", "", None
            except Exception as error:  # noqa: BLE001 - a page must not end the crawl
                yield id_, url, f"error:{type(error).__name__}", "", None


class PagesHttp(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pages_http"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagesHttp)
