import functools
import heapq
import math
import random
import tracemalloc
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestone.operators import clean, crawl, dedup, dense, devset, evaluate, fusion, lexical, ranking
from lodestone.sources import http, readers, writers


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


# ---- sources ----------------------------------------------------------------------------------------------------


def test_docs_jsonl_skips_bad_lines_and_keeps_the_first(spark, tmp_path):
    (tmp_path / "docs.jsonl").write_text('{"id":1,"url":"u","text":"first","seq":1}\n{"id":1,"text":"second","seq":2}\nnot json\n{"id":2,"text":"x","se')
    assert rows_of(readers.docs_jsonl(spark, str(tmp_path / "docs.jsonl")), "id", "text") == [(1, "first")]
    (tmp_path / "plain.jsonl").write_text('{"id":1,"text":"a"}\n{"id":1,"text":"b"}\n')
    assert rows_of(readers.docs_jsonl(spark, str(tmp_path / "plain.jsonl")), "id", "text") == [(1, "a")]


def test_chunks_jsonl_is_strict(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"chunk_id":"1:0"}\nbroken\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.chunks_jsonl(spark, str(tmp_path / "c.jsonl")).collect()


def test_missing_links_are_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.links(spark, str(tmp_path / "none.parquet"))


def test_vectors_in_order_and_missing_ones(spark):
    vectors = spark.createDataFrame([("a", [1.0]), ("b", [2.0])], "chunk_id string, embedding array<float>")
    wanted = spark.createDataFrame([(1, "b"), (2, "a")], "position int, chunk_id string")
    assert rows_of(readers.vectors_in_order(vectors, wanted), "position", "chunk_id") == [(1, "b"), (2, "a")]
    with pytest.raises(Exception, match="no vector for z"):
        readers.vectors_in_order(vectors, spark.createDataFrame([(1, "z")], "position int, chunk_id string")).collect()
    assert rows_of(readers.index_mismatch(vectors.select("chunk_id"), vectors.where("chunk_id = 'a'")), "chunk_id", "missing") == [("b", "vector")]


def test_submission_file_and_zip(spark, tmp_path):
    answers = spark.createDataFrame([(2, [5], [(5, "ü")]), (1, [], [])], "id long, relevant_docs array<long>, relevant_chunks array<struct<doc_id:long,chunk_text:string>>")
    packed = writers.submission(answers, str(tmp_path / "out.json"))
    assert zipfile.ZipFile(packed).namelist() == ["out.json"]
    back = readers.answers_json(spark, str(tmp_path / "out.json"))
    assert rows_of(back, "id", "relevant_docs") == [(1, []), (2, [5])] and "ü" in (tmp_path / "out.json").read_text()
    assert evaluate.validate(back, answers).count() == 0


def test_throttle_and_robots():
    now, slept = [0.0], []
    throttle = http.Throttle(1.0, clock=lambda: now[0], sleep=slept.append)
    for host in ("a", "a", "b", "a"):
        throttle.wait(host)
    assert slept == [1.0, 2.0]
    asked = []

    def fetch(url):
        asked.append(url)
        if "broken" in url:
            raise OSError
        return "", b"User-agent: *\nDisallow: /private"

    robots = http.Robots("me", fetch)
    assert robots.allow("http://a/x") and not robots.allow("http://a/private/y") and robots.allow("http://broken/private")
    assert len(asked) == 2


# ---- corpus -----------------------------------------------------------------------------------------------------


def test_resume_and_last_status(spark):
    log = spark.createDataFrame([(1, 1, "u", "ok"), (2, 2, "u", "ok"), (3, 2, "u", "http_500")], "seq long, id long, url string, status string")
    todo = spark.createDataFrame([(k,) for k in (1, 2, 3)], "id long")
    assert rows_of(crawl.resume(todo, log), "id") == [(3,)] and rows_of(crawl.resume(todo, log, True), "id") == [(2,), (3,)]
    assert rows_of(crawl.crawl_summary(log), "status", "n") == [("http_500", 1), ("ok", 1)]


def test_interleave_takes_turns(spark):
    links = spark.createDataFrame([(k, "http://a/", k) for k in range(4)] + [(k, "http://b/", k) for k in range(70000, 70002)], "id long, url string, seq long")
    order = [r.id for r in crawl.interleave(crawl.with_host(links)).orderBy("turn", "host", "seq").collect()]
    assert order == [0, 70000, 1, 2, 70001, 3]


def test_plan_crawl_filters_in_order(spark):
    links = spark.createDataFrame([(k, f"http://h{k % 3}/{k}", k) for k in range(30)], "id long, url string, seq long")
    log = spark.createDataFrame([], "seq long, id long, url string, status string")
    planned = crawl.plan_crawl(links, log, limit=5, per_host=4, exclude=["h2"])
    assert planned.count() == 5 and {r.host for r in planned.collect()} <= {"h0", "h1"}


@pytest.mark.parametrize(
    "html, status, wanted",
    [("x" * 49, "fetched", "empty"), ("x" * 50, "fetched", "blocked"), ("x" * 149, "fetched", "blocked"), ("x" * 150, "fetched", "ok"), ("я" * 200, "fetched", "garbled"), ("x" * 300, "http_404", "http_404"), ("Just a moment..." + "x" * 300, "fetched", "blocked")],
)
def test_page_status(spark, html, status, wanted):
    page = spark.createDataFrame([(1, "http://h/", status, html)], "id long, url string, status string, html string")
    row = crawl.extract_pages(page).first()
    assert row.status == wanted and (row.text == html) == (wanted == "ok")


def test_repair(spark):
    docs = spark.createDataFrame([(1, "u", "я" * 50, 1), (2, "u", "я" * 50, 2), (3, "u", "fine", 3), (3, "u", "later", 4)], "id long, url string, text string, seq long")
    fetched = spark.createDataFrame([(1, "u", "ok", "good"), (2, "u", "empty", ""), (3, "u", "ok", "not asked")], "id long, url string, status string, text string")
    kept, failed = crawl.repair(docs, fetched)
    assert rows_of(kept, "id", "text") == [(1, "good"), (3, "fine")] and rows_of(failed, "id", "status") == [(2, "empty")]
    crawl.checked_repair(3, 1, 1, 2)
    with pytest.raises(ValueError):
        crawl.checked_repair(3, 1, 1, 3)


def test_boilerplate(spark):
    docs = [(k, "h", f"menu \n\nbody {k}\nmenu") for k in range(10)] + [(100, "h", "menu"), (101, "g", "menu\nbody")]
    found = spark.createDataFrame(docs, "id long, host string, text string")
    assert rows_of(clean.boilerplate_lines(found), "host", "line", "n") == [("h", "menu", 11)]
    cleaned = {r.id: r.text for r in clean.clean_docs(found).collect()}
    assert cleaned[3] == "body 3" and 100 not in cleaned and cleaned[101] == "menu\nbody"


# ---- near duplicates --------------------------------------------------------------------------------------------


def clusters_by_definition(sigs, max_distance=3, bands=4, most=500):
    """A document's representative after some bands, from those of the smaller ids of its bucket."""
    near = lambda x, y: (sigs[x] ^ sigs[y]).bit_count() <= max_distance
    key = lambda d, band: (sigs[d] >> (64 // bands * band)) % 2 ** (64 // bands)

    @functools.cache
    def head(doc, done):
        if not done or head(doc, done - 1) != doc:
            return head(doc, done - 1) if done else doc
        bucket = heapq.nsmallest(most, (d for d in sigs if key(d, done - 1) == key(doc, done - 1)))
        smaller = [d for d in bucket if d < doc] if doc in bucket else []
        return next((d for d in smaller if head(d, done) == d and near(d, doc)), doc)

    found = {d: head(d, bands) for d in sigs}
    return {d: r for d, r in found.items() if list(found.values()).count(r) > 1}


@pytest.mark.parametrize("seed", range(3))
def test_clusters_as_one_after_another(spark, seed):
    rng = random.Random(seed)
    bases = [rng.getrandbits(64) for _ in range(6)]
    sigs = {d: bases[rng.randrange(6)] ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 3))) & (2**64 - 1) for d in range(60)}
    table = spark.createDataFrame([(d, s - 2**64 if s >= 2**63 else s) for d, s in sigs.items()] + [(99, None)], "doc_id long, sig long")
    assert {r.doc_id: r.cluster_id for r in dedup.cluster(table).collect()} == clusters_by_definition(sigs)
    assert {r.doc_id: r.cluster_id for r in dedup.cluster(table, max_bucket=3).collect()} == clusters_by_definition(sigs, most=3)
    pairs = {(r.a, r.b): r.distance for r in dedup.lsh_pairs(table).collect()}
    first = {s: min(d for d in sigs if sigs[d] == s) for s in sigs.values()}
    wanted = {(a, b): (sigs[a] ^ sigs[b]).bit_count() for a in first.values() for b in first.values() if a < b and (sigs[a] ^ sigs[b]).bit_count() <= 3}
    assert pairs == wanted | {(first[s], d): 0 for d, s in sigs.items() if d != first[s]}


def test_reposts_are_near(spark):
    article = " ".join(f"word{k % 40} about medicine {k % 7}" for k in range(60))
    docs = spark.createDataFrame([(1, article), (2, article + " source: the daily"), (3, "other text altogether here " * 20), (4, "short")], "doc_id long, text string")
    sigs = {r.doc_id: r.sig for r in dedup.signatures(docs).collect()}
    assert sigs[4] is None and (sigs[1] ^ sigs[2]) & (2**64 - 1) != 0 or sigs[1] == sigs[2]
    assert {r.doc_id: r.cluster_id for r in dedup.cluster(dedup.signatures(docs)).collect()} == {1: 1, 2: 1}


def test_signatures_hold_few_tokens_at_once():
    """Tokens of a batch aren't Python's strings all at once, which took a task over ten times the batch."""
    rng = random.Random(5)
    docs = [[f"w{rng.randrange(10**6)}" for _ in range(n)] for n in [0, 1, 59, 60, 61, *[200] * 2000]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(docs) + 1)), pa.array([*docs, None], pa.list_(pa.string()))], names=["doc_id", "tokens"])
    run = dedup._signed(60, at_once=5000)
    tracemalloc.start()
    (found,) = run([batch])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.column("sig").to_pylist() == [dedup.simhash(d) if len(d) >= 60 else None for d in docs] + [None]
    assert peak < 5e6


# ---- retrieval --------------------------------------------------------------------------------------------------


def test_bm25_by_hand(spark):
    chunks = lexical.tokenized(spark.createDataFrame([("a", "vi", "đau đầu"), ("b", "vi", ""), ("c", "zh", "头痛 đau")], "chunk_id string, lang string, text string"), words_only=True)
    asked = lexical.tokenized(spark.createDataFrame([(1, "đau đau"), (2, "nothing")], "query_id long, text string"), words_only=True)
    found = {(r.query_id, r.lang, r.chunk_id): r.score for r in lexical.search_corpus(asked, chunks, 5).collect()}
    assert set(found) == {(1, "vi", "a"), (1, "zh", "c")}
    idf = math.log(1 + (2 - 1 + 0.5) / 1.5)
    assert found[1, "vi", "a"] == pytest.approx(2 * idf / (1 + 1.5 * (0.25 + 0.75 * 2 / 1.5)))


def test_index_is_the_same_as_no_index(spark, tmp_path):
    chunks = spark.createDataFrame([(f"{k}", "en", f"term{k % 3} term{k % 5} common") for k in range(30)], "chunk_id string, lang string, text string")
    asked = lexical.tokenized(spark.createDataFrame([(1, "term1 common"), (2, "term4")], "query_id long, text string"))
    index, stats = lexical.build_index(chunks, str(tmp_path / "i"))
    a = rows_of(lexical.search(asked, index, stats, 7), "query_id", "chunk_id", "rank")
    assert a == rows_of(lexical.search_corpus(asked, lexical.tokenized(chunks), 7), "query_id", "chunk_id", "rank")


def _bm25(rows, asked, k, by_language):
    """{(query, lang, chunk, rank)} by definition; rows (chunk, lang, tokens), asked {query: tokens}."""
    out = set()
    for q, terms in asked.items():
        scored = []
        for c, lang, tokens in rows:
            own = [t for _, g, t in rows if g == lang]
            mean, s = sum(max(len(t), 1) for t in own) / len(own), 0.0
            for term in terms:
                tf, df = tokens.count(term), sum(term in t for t in own)
                s += math.log(1 + (len(own) - df + 0.5) / (df + 0.5)) * tf / (tf + 1.5 * (0.25 + 0.75 * max(len(tokens), 1) / mean))
            scored += [(lang if by_language else "", -round(s, 6), c, lang)] if s > 0 else []
        for g in {x[0] for x in scored}:
            out |= {(q, lang, c, n) for n, (_, _, c, lang) in enumerate(sorted(x for x in scored if x[0] == g)[:k], 1)}
    return out


@pytest.mark.parametrize("by_language", [True, False])
def test_search_by_definition(spark, monkeypatch, by_language):
    rng = random.Random(3)
    rows = [(f"c{rng.randrange(10**6)}:{n}", rng.choice("xyz"), [f"t{int(rng.random() ** 2 * 12)}" for _ in range(rng.randrange(9))]) for n in range(160)]
    rows += [(f"same{n}", "x", ["t1", "t2", "t2"]) for n in range(60)]  # ties of more chunks than a list takes
    asked = {n: [f"t{rng.randrange(14)}" for _ in range(rng.randrange(7))] for n in range(11)}
    chunks = spark.createDataFrame([*rows, ("none", None, ["t1"]), ("nothing", "x", None)], "chunk_id string, lang string, tokens array<string>").repartition(3)
    queries = spark.createDataFrame(list(asked.items()), "query_id long, tokens array<string>")
    monkeypatch.setattr(lexical, "BLOCK", 4)
    best = lexical._best_of_tasks
    monkeypatch.setattr(lexical, "_best_of_tasks", lambda *a: best(*a, cells=64))
    found = lexical.search_corpus(queries, chunks, 5, by_language).collect()
    assert {(r.query_id, r.lang, r.chunk_id, r["rank"]) for r in found} == _bm25(rows, asked, 5, by_language)
    assert lexical.search_corpus(queries.limit(0), chunks, 5).count() == 0 == lexical.search_corpus(queries, chunks.limit(0), 5).count()


def test_search_writes_and_shuffles_no_more_than_chunks(spark, monkeypatch):
    """Neither a row for each posting nor one for each pair of query and chunk."""
    chunks = spark.createDataFrame([(n, "", [f"t{(n * k) % 30}" for k in range(40)]) for n in range(500)], "chunk_id long, lang string, tokens array<string>").repartition(2)
    asked = spark.createDataFrame([(q, [f"t{(q + k) % 30}" for k in range(20)]) for q in range(30)], "query_id long, tokens array<string>")
    written, stored = [], lexical.stored
    monkeypatch.setattr(lexical, "stored", lambda df, name: written.append(stored(df, name)) or written[-1])
    assert lexical.search_corpus(asked, chunks, 3).count() == 90
    assert all(t.count() <= 500 for t in written)


def test_chunks_are_not_shuffled_for_candidates(spark):
    candidates = spark.createDataFrame([(1, "a", 0.5, 1)], "query_id long, chunk_id string, fusion double, rank int")
    chunks = spark.range(1000).select(F.concat(F.lit("c"), "id").alias("chunk_id"), F.col("id").alias("doc_id"))
    plan = ranking.with_chunks(candidates, chunks)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan


def test_vectors(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(40, 16))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    table = spark.createDataFrame([(f"c{k:02d}", k, ("vi", "zh")[k % 2], v[k].tolist()) for k in range(40)], "chunk_id string, doc_id long, lang string, embedding array<float>").repartition(5)
    asked = table.select(F.col("doc_id").alias("query_id"), "embedding")
    hits = dense.search_vectors(asked, table, 3).collect()
    best = {r.query_id: (r.chunk_id, r.score) for r in hits if r["rank"] == 1}
    assert all(best[k][0] == f"c{k:02d}" and best[k][1] > 0.99 for k in range(40)) and len(hits) == 120
    order = np.argsort(-(v @ v.T), axis=1, kind="stable")[:, :3]
    assert {(r.query_id, r["rank"]): r.chunk_id for r in hits} == {(k, n + 1): f"c{order[k, n]:02d}" for k in range(40) for n in range(3)}
    only = dense.search_vectors(asked, table, 3, langs=["vi"]).collect()
    assert all(int(r.chunk_id[1:]) % 2 == 0 for r in only)
    assert dense.search_vectors(asked.limit(0), table, 3).count() == 0
    pairs = dense.pairs_within(asked.where("query_id < 2"), table)
    assert pairs.count() == 80


def test_hashed_embedder_likes_what_is_alike(spark):
    texts = spark.createDataFrame([("a", "heart attack risk"), ("b", "heart attack risks today"), ("c", "banana bread recipe"), ("d", "")], "chunk_id string, text string")
    e = {r.chunk_id: np.array(r.embedding) for r in dense.HashedEmbedder(128).encode_docs(texts).collect()}
    assert np.linalg.norm(e["a"]) == pytest.approx(1, abs=1e-5) and not e["d"].any() and e["a"] @ e["b"] > e["a"] @ e["c"]
    model = {r.chunk_id: r.embedding for r in dense.encode_with(texts, lambda: lambda xs: [[len(x), 1.0] for x in xs]).collect()}
    assert np.linalg.norm(model["a"]) == pytest.approx(1, abs=1e-5)


def slow_rrf(lists, k=60, weights=None):
    scores = {}
    for name, ids in lists.items():
        for rank, i in enumerate(dict.fromkeys(ids), 1):
            scores[i] = scores.get(i, 0) + (weights or {}).get(name, 1.0) / (k + rank)
    return [i for i, _ in sorted(scores.items(), key=lambda x: (-round(x[1], 9), x[0]))]


def test_rrf(spark):
    rng = random.Random(0)
    for _ in range(4):
        lists = {n: [f"d{rng.randrange(12)}" for _ in range(10)] for n in ("x", "y", "z")}
        rows = [(1, n, i, r) for n, ids in lists.items() for r, i in enumerate(ids, 1)]
        rng.shuffle(rows)
        table = spark.createDataFrame(rows, "query_id long, list_name string, chunk_id string, rank int")
        for weights in (None, {"x": 2.0}):
            assert [r.chunk_id for r in fusion.rrf(table, weights=weights).orderBy("rank").collect()] == slow_rrf(lists, weights=weights)


def test_pooled(spark):
    lists = spark.createDataFrame([(1, "bm25", 5, "5:0", 1), (1, "bm25", 5, "5:1", 2), (1, "dense", 5, "5:1", 3), (1, "dense", 6, "6:0", 1), (1, "dense", 7, "7:0", 41)], "query_id long, mode string, doc_id long, chunk_id string, rank int")
    found = fusion.pooled(lists).orderBy("doc_rank", "chunk_rank").collect()
    assert [(r.doc_id, r.chunk_id, r.modes) for r in found] == [(5, "5:1", ["bm25", "dense"]), (5, "5:0", ["bm25", "dense"]), (6, "6:0", ["dense"])]
    assert found[0].doc_score == pytest.approx(1 / 61 + 1 / 63)


def test_rerank_falls_back_when_silent(spark):
    rows = spark.createDataFrame([(1, "a", 0.5, 1, 0.0), (1, "b", 0.4, 2, 0.0), (2, "a", 0.5, 1, 0.0), (2, "b", 0.4, 2, -1.0)], "query_id long, chunk_id string, fusion double, rank int, s double")
    assert rows_of(ranking.rerank(rows, F.col("s")), "query_id", "chunk_id", "score") == [(1, "a", 0.5), (1, "b", 0.4), (2, "a", 0.0), (2, "b", -1.0)]


def test_doc_scores_and_passages(spark):
    ranked = spark.createDataFrame(
        [(1, 5, f"5:{k}", f"t{k}", f"p{k}", "en", s, k + 1) for k, s in enumerate((1.0, 0.7, 0.59, 0.9))] + [(1, 6, "6:0", "t", "p", "en", 0.0, 9)],
        "query_id long, doc_id long, chunk_id string, text string, parent_text string, lang string, score double, rank int",
    )
    placed = ranking.chunk_ranks(ranked)
    docs = ranking.doc_scores(placed)
    assert {r.doc_id: r.rel for r in docs.collect()} == {5: pytest.approx(1.16), 6: 0.0}
    chosen = docs.withColumn("rank", F.col("doc_id"))
    picked = ranking.pick_chunks(chosen, placed, unit="parent").orderBy("place").collect()
    assert [r.chunk_text for r in picked] == ["p0", "p3", "p1"]


FEATURES = "query_id long, doc_id long, rel double, host string, cluster long, lang string, embedding array<float>"


def test_agreement_counts_other_hosts(spark):
    docs = spark.createDataFrame(
        [(1, 1, 1.0, "a", 1, "en", [1.0, 0.0]), (1, 2, 0.9, "a", 2, "en", [1.0, 0.0]), (1, 3, 0.8, "b", 1, "en", [1.0, 0.0]), (1, 4, 0.7, "c", 4, "en", [1.0, 0.1]), (1, 5, 0.1, "d", 5, "en", [1.0, 0.0]), (2, 9, 1.0, "x", 9, "en", [1.0, 0.0])],
        FEATURES,
    )
    found = {r.doc_id: (r.support_hosts, r.final) for r in ranking.rescored(ranking.agreement(docs, 0.55)).collect()}
    assert found[1][0] == ["c"] and found[5][0] == ["a", "b", "c"] and found[9][0] == []
    assert found[1][1] == pytest.approx(1 + 0.3 * math.log(2))
    sims = spark.createDataFrame([(1, 1, 4, 0.9)], "query_id long, a long, b long, cos double")
    assert {r.doc_id: r.support_hosts for r in ranking.agreement(docs, 0.55, similarity=sims).collect()}[1] == ["c"]


def belongs(doc, before, best, lo, hi, share, cap, dedupe):
    """Should a document be chosen, given the chosen ones ahead of it?"""
    same_host = [d for d in before if d["host"] == doc["host"]]
    repeats = dedupe and any(d["cluster"] == doc["cluster"] for d in before)
    near_best = best > 0 and doc["final"] / best >= share
    return len(same_host) < cap and not repeats and len(before) < hi and (near_best or len(before) < lo)


@pytest.mark.parametrize("dedupe", [False, True])
def test_every_choice_follows_from_those_ahead_of_it(spark, dedupe):
    rng = random.Random(7)
    docs = [
        {"query_id": q, "doc_id": d, "final": round(rng.uniform(-0.2, 1), 1), "host": rng.choice("abc"), "cluster": rng.randrange(4), "first_rank": rng.randrange(5)} for q in range(60) for d in range(rng.randint(1, 12))
    ]
    table = spark.createDataFrame([tuple(d.values()) for d in docs], "query_id long, doc_id long, final double, host string, cluster long, first_rank int")
    found = {}
    for r in ranking.select_docs(table, 1, 4, 0.55, 2, dedupe).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.doc_id))
    for q in range(60):
        mine = sorted((d for d in docs if d["query_id"] == q), key=lambda d: (-d["final"], d["first_rank"], d["doc_id"]))
        chosen = [d for _, d in sorted(found.get(q, []))]
        assert chosen == [d["doc_id"] for d in mine if d["doc_id"] in chosen]
        for at, doc in enumerate(mine):
            ahead = [d for d in mine[:at] if d["doc_id"] in chosen]
            assert (doc["doc_id"] in chosen) == belongs(doc, ahead, mine[0]["final"], 1, 4, 0.55, 2, dedupe)


# ---- evaluation -------------------------------------------------------------------------------------------------

GOLD = "id long, relevant_docs array<string>, relevant_chunks array<struct<doc_id:string,chunk_text:string>>"


def test_doc_prf(spark):
    row = evaluate.doc_prf(spark.createDataFrame([(1, [7, 8, 9, 10, 11], ["7", "9", "12"])], "id long, pred array<long>, gold array<string>")).first()
    assert (row.doc_p, row.doc_r) == (0.4, pytest.approx(2 / 3)) and row.doc_f2 == pytest.approx(10 / 17)
    none = evaluate.doc_prf(spark.createDataFrame([(1, [], ["2"]), (2, [1], [])], "id long, pred array<long>, gold array<string>")).collect()
    assert all((r.doc_p, r.doc_r, r.doc_f2) == (0, 0, 0) for r in none)


def test_evaluate(spark):
    gold = spark.createDataFrame([(1, ["10", "11"], [("10", "heart  attack &amp; risk"), ("11", "unseen words here")]), (2, ["20"], [])], GOLD)
    pred = spark.createDataFrame([(1, ["10"], [("10", "the HEART attack & risk today"), ("11", "heart attack & risk"), ("10", "nothing alike")]), (3, ["1"], [])], GOLD)
    row = evaluate.evaluate(pred, gold).first()
    assert row.n_queries == 2 and row.doc_r == 0.25 and row.doc_p == 0.5
    assert row.chunk_p == pytest.approx((1 / 3) / 2) and row.chunk_r == 0.25
    empty = evaluate.evaluate(pred, gold.limit(0)).first()
    assert empty.n_queries == 0 and empty.doc_f2 == 0


def test_validation_names_what_is_wrong(spark):
    answers = spark.createDataFrame([(1, ["5"], [("5", "  "), ("6", "x")]), (1, [], []), (9, [], [])], GOLD)
    found = rows_of(evaluate.validate(answers, spark.createDataFrame([(1,), (2,)], "id long")), "kind", "id")
    assert found == [("blank", 1), ("missing", 2), ("repeated", 1), ("stray", 1), ("unexpected", 9)]


CHOSEN = "query_id long, doc_id long, host string, lang string, support_hosts array<string>"


def test_diversity_and_bias(spark):
    chosen = spark.createDataFrame([(1, 1, "a", "vi", ["b"]), (1, 2, "b", "zh", []), (2, 3, "a", "vi", [])], CHOSEN)
    rows = {r.query_id: r for r in evaluate.diversity(chosen, spark.createDataFrame([(1,), (2,), (3,)], "query_id long")).collect()}
    assert (rows[1].hosts, rows[1].langs, rows[1].corroborated, rows[1].single_source) == (2, 2, 1, False) and rows[1].lang_counts == {"vi": 1, "zh": 1}
    assert rows[2].single_source and rows[3].single_source and rows[3].docs == 0
    bias = {(r.measure, r.name): r.value for r in evaluate.bias_report(chosen).collect()}
    assert bias["queries", ""] == 2 and bias["single_source", ""] == 1 and bias["lang_share", "vi"] == pytest.approx(2 / 3)
    assert bias["host_entropy", ""] == pytest.approx(-(2 / 3 * math.log2(2 / 3) + 1 / 3 * math.log2(1 / 3)))


# ---- development queries ----------------------------------------------------------------------------------------


def test_strata_are_quartiles_with_ties_together(spark):
    import pandas as pd

    for lengths in ([1, 1, 1, 1, 2, 3, 4, 8], [5, 5, 5], [1, 2, 3, 4, 5, 6, 7, 8, 9]):
        table = spark.createDataFrame([(k, " ".join(["w"] * n)) for k, n in enumerate(lengths)], "id long, query string")
        found = [r.len_bin for r in devset.strata(table).orderBy("id").collect()]
        expected = pd.qcut(pd.Series(lengths), 4, labels=False, duplicates="drop")
        assert found == [0 if pd.isna(x) else int(x) for x in expected]


def test_sample_and_replacements(spark):
    queries = spark.createDataFrame([(k, ("mẹ " if k % 4 == 0 else "") + " ".join(["w"] * (k % 9 + 1))) for k in range(200)], "id long, query string")
    dev = devset.sample_queries(queries, 40).cache()
    assert dev.count() == 40 and dev.select("id").distinct().count() == 40 and 6 <= dev.where("narrative").count() <= 14
    status = dev.selectExpr("id", "case when id % 3 = 0 then 'skip' else 'todo' end as status")
    skipped = status.where("status = 'skip'").count()
    new = devset.replacements(queries, dev, status, 40)
    assert new.count() == skipped and new.join(dev, "id").count() == 0 and new.select("id").distinct().count() == skipped
    assert devset.replacements(queries, dev, dev.selectExpr("id", "'todo' as status"), 45).count() == 0
    assert devset.sample_queries(queries, 500).count() == 200


def test_labels(spark):
    one = [("2", "x")]
    events = spark.createDataFrame(
        [(1, 1, ["1", "1"], one, "todo"), (2, 1, ["1", "1"], one, "done"), (3, 2, ["1"], [], "skip"), (4, 3, [], [], "done"), (5, 4, ["1"], [], "done"), (6, 4, ["1"], [], "todo"), (7, 5, None, None, "todo")],
        "seq long, qid long, docs array<string>, chunks array<struct<doc_id:string,chunk_text:string>>, status string",
    )
    state = devset.label_state(events)
    found = {r.qid: (r.docs, r.state, r.status) for r in state.collect()}
    assert found == {1: (["1", "2"], "gold", "done"), 2: ([], "skipped", "skip"), 3: ([], "none", "todo"), 4: (["1"], "draft", "todo"), 5: ([], "none", "todo")}
    assert rows_of(devset.gold_answers(state), "id") == [(1,)]
    assert rows_of(devset.progress(spark.createDataFrame([(k,) for k in range(1, 8)], "id long"), state), "status", "n") == [("done", 1), ("skip", 1), ("todo", 5)]


def test_label_rules(spark):
    row = spark.createDataFrame([(["1"], [("1", "x")])], "docs array<string>, chunks array<struct<doc_id:string,chunk_text:string>>")
    docs, chunks = devset.pick_chunk(F.col("docs"), F.col("chunks"), F.struct(F.lit("2").alias("doc_id"), F.lit("y").alias("chunk_text")))
    got = row.select(docs.alias("d"), F.size(chunks).alias("c"), *[c.alias(n) for c, n in zip(devset.untick_doc(F.col("docs"), F.col("chunks"), F.lit("1")), "ef", strict=True)]).first()
    assert (got.d, got.c, got.e, got.f) == (["1", "2"], 2, [], [])
