"""Search and labelling over HTTP, with the standard library's server. Every request is a batch of one query."""

from __future__ import annotations

import json
import threading
import time
from dataclasses import replace
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .config import DEFAULTS
from .operators import devset, evaluate, ranking
from .operators.dense import HashedEmbedder
from .plans import retrieval as R
from .plans.corpus import load_corpus
from .sources import readers, writers

PAGE = "<!doctype html><meta charset=utf-8><title>{0}</title><h1>{0}</h1><form method=post action=/api/search><textarea name=query></textarea></form>"


class Service:
    """The endpoints as methods. Options belong to a call, never to the service, so requests can't disturb each other."""

    def __init__(self, spark: SparkSession, data: str, corpus: R.Corpus | None = None, embedder=None, reranker=None):
        self.spark, self.data = spark, data
        self.corpus = corpus or load_corpus(spark, data)
        self.embedder = embedder or HashedEmbedder()
        # A function from (query text, embed text) columns to a score column.
        self.reranker = reranker
        self.lock = threading.Lock()

    def health(self) -> dict:
        return self.corpus.health().first().asDict() | {"expander": False}

    def search(self, query: str, mode: str = "hybrid", rerank: bool = False, output_unit: str = "child", stratify: bool = True, consensus: bool = True, host_cap: int | None = None) -> dict:
        began = time.perf_counter()
        if rerank and self.reranker is None:
            raise ValueError("this service has no reranker")
        asked = self.spark.createDataFrame([(0, query)], "id long, query string")
        embedded = self.embedder.encode_queries(R.expand_queries(asked)).select("query_id", "variant", "embedding") if self.corpus.vectors is not None else None
        settings = replace(DEFAULTS, host_cap=host_cap or DEFAULTS.host_cap)
        chosen, passages = R.retrieve(self.corpus, asked, mode, self.reranker if rerank else None, stratify, consensus, None, output_unit, settings, embedded=embedded)
        docs = [r.asDict(True) for r in ranking.detail_view(chosen).orderBy("rank").collect()]
        texts = [r.asDict(True) for r in passages.orderBy("rank", "place").collect()]
        shown = evaluate.diversity(chosen, asked.select(F.col("id").alias("query_id"))).first().asDict(True)
        return {"docs": docs, "chunks": texts, "diversity": shown, "seconds": round(time.perf_counter() - began, 3)}

    # labelling

    def events(self):
        path = f"{self.data}/labels"
        try:
            return self.spark.read.parquet(path)
        except Exception as error:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], "seq long, qid long, docs array<string>, chunks array<struct<doc_id:string,chunk_text:string>>, status string")

    def queries(self) -> list[dict]:
        dev = self.spark.read.schema("id long, query string").option("multiLine", True).json(f"{self.data}/dev_queries.json")
        return [r.asDict() for r in devset.with_status(dev, devset.label_state(self.events())).orderBy("id").collect()]

    def label(self, qid: int) -> dict:
        found = devset.label_state(self.events().where(F.col("qid") == qid)).first()
        return found.asDict(True) if found else {"qid": qid, "docs": [], "chunks": [], "state": "none", "status": "todo"}

    def set_label(self, qid: int, docs: list, chunks: list[dict], status: str) -> dict:
        with self.lock:
            named = [(str(c["doc_id"]), c["chunk_text"]) for c in chunks]
            row = [(time.time_ns(), qid, [str(d) for d in docs], named, status)]
            event = self.spark.createDataFrame(row, "seq long, qid long, docs array<string>, chunks array<struct<doc_id:string,chunk_text:string>>, status string")
            writers.append(event, f"{self.data}/labels")
        return self.label(qid)

    def pool(self, query: str) -> list[dict]:
        asked = self.spark.createDataFrame([(0, query)], "id long, query string")
        embedded = self.embedder.encode_queries(R.expand_queries(asked)).select("query_id", "variant", "embedding") if self.corpus.vectors is not None else None
        return [r.asDict(True) for r in R.pooled_search(self.corpus, asked, embedded=embedded).orderBy("doc_rank", "chunk_rank").collect()]

    def document(self, doc_id: int) -> dict | None:
        found = readers.docs_by_id(self.spark.read.parquet(f"{self.data}/docs"), [doc_id]).orderBy("seq").first()
        return found.asDict() if found else None


def handler(service: Service) -> type[BaseHTTPRequestHandler]:
    class Handler(BaseHTTPRequestHandler):
        def answer(self, body, kind: str = "application/json", code: int = 200) -> None:
            data = (body if isinstance(body, str) else json.dumps(body, ensure_ascii=False, default=str)).encode()
            self.send_response(code)
            self.send_header("Content-Type", f"{kind}; charset=utf-8")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def do_GET(self) -> None:  # noqa: N802
            parts = self.path.strip("/").split("/")
            if parts == [""]:
                self.answer(PAGE.format("Search"), "text/html")
            elif parts == ["api", "health"]:
                self.answer(service.health())
            elif parts == ["api", "queries"]:
                self.answer(service.queries())
            elif parts[:2] == ["api", "label"] and len(parts) == 3:
                self.answer(service.label(int(parts[2])))
            elif parts[:2] == ["api", "doc"] and len(parts) == 3:
                found = service.document(int(parts[2]))
                self.answer(found or {"error": "no such document"}, code=200 if found else 404)
            else:
                self.answer({"error": "no such page"}, code=404)

        def do_POST(self) -> None:  # noqa: N802
            try:
                asked = json.loads(self.rfile.read(int(self.headers.get("Content-Length", 0))) or b"{}")
                parts = self.path.strip("/").split("/")
                if parts == ["api", "search"]:
                    self.answer(service.search(**asked))
                elif parts == ["api", "pool"]:
                    self.answer(service.pool(asked["query"]))
                elif parts[:2] == ["api", "label"] and len(parts) == 3:
                    self.answer(service.set_label(int(parts[2]), asked.get("docs", []), asked.get("chunks", []), asked.get("status", "todo")))
                else:
                    self.answer({"error": "no such page"}, code=404)
            except (TypeError, ValueError, KeyError) as error:
                self.answer({"error": str(error)}, code=400)

    return Handler


def serve(spark: SparkSession, data: str, port: int) -> None:
    ThreadingHTTPServer(("127.0.0.1", port), handler(Service(spark, data))).serve_forever()
