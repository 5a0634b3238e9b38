"""Settings. The defaults are fixed values: they are part of what the operators compute."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # crawl planning
    crawl_workers: int = 16
    host_delay_s: float = 1.0
    timeout_s: int = 30
    obey_robots: bool = True
    keep_raw: bool = False
    # chunks
    chunk_max_tokens: int = 220
    chunk_overlap_tokens: int = 40
    parent_max_tokens: int = 700
    # candidates
    bm25_candidates: int = 100
    dense_candidates: int = 100
    rrf_k: int = 60
    rerank_candidates: int = 60
    stratify: bool = True
    per_stratum: int = 30
    languages: tuple[str, ...] = ("vi", "en", "zh")
    # documents and passages
    doc_min: int = 1
    doc_max: int = 8
    doc_rel_threshold: float = 0.55
    host_cap: int = 2
    dedupe_clusters: bool = False
    chunk_max_per_doc: int = 3
    chunk_rel_threshold: float = 0.6
    # consensus
    consensus: bool = True
    agree_theta: float = 0.62
    agree_rel_min: float = 0.3
    agree_alpha: float = 0.3
    # near duplicates
    simhash_min_tokens: int = 60
    simhash_max_chars: int = 4000
    cluster_max_distance: int = 3
    cluster_bands: int = 4
    cluster_max_bucket: int = 500
    # boilerplate
    boilerplate_min_docs: int = 8
    boilerplate_min_share: float = 0.05
    boilerplate_max_line: int = 200
    # evaluation
    chunk_match: float = 0.40
    pool_depth: int = 40
    pool_docs: int = 25
    # lexical scoring
    bm25_k1: float = 1.5
    bm25_b: float = 0.75


DEFAULTS = Settings()
