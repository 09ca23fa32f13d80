"""All queries of the core and their SQL."""

from __future__ import annotations

from . import index_queries, ingest_queries, rag_queries, search_queries, triage_queries

QUERIES, ORACLE = {}, {}
for _m in (triage_queries, ingest_queries, search_queries, index_queries, rag_queries):
    QUERIES |= _m.QUERIES
    ORACLE |= _m.ORACLE
