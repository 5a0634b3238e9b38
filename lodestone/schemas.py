"""Table schemas. ``seq`` is the order of arrival, which decides wherever first or last wins."""

from __future__ import annotations

DOCS = "id long, url string, lang string, title string, text string, source string, extractor string, seq long"
CHUNKS = "chunk_id string, doc_id long, ordinal int, text string, context string, parent_text string, lang string"
LINKS = "id long, url string"
QUERIES = "id long, query string"
CRAWL_LOG = "seq long, id long, url string, status string"
CLUSTERS = "doc_id long, cluster_id long"
VECTORS = "chunk_id string, doc_id long, lang string, embedding array<float>"
ANSWERS = "id long, relevant_docs array<long>, relevant_chunks array<struct<doc_id:long,chunk_text:string>>"
GOLD = "id long, relevant_docs array<string>, relevant_chunks array<struct<doc_id:string,chunk_text:string>>"
LABEL_EVENTS = "seq long, qid long, docs array<string>, chunks array<struct<doc_id:string,chunk_text:string>>, status string"
#: A ranked list has one row per entry, its rank explicit.
RANKED = "query_id long, list_name string, chunk_id string, score double, rank int"
