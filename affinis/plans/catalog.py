"""All registered queries and oracles."""

from __future__ import annotations

from affinis.plans import evaluation_queries, rating_queries, source_queries, tag_queries, text_queries, vector_queries

_MODULES = (rating_queries, tag_queries, evaluation_queries, text_queries, vector_queries, source_queries)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
