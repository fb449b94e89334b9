"""Registered queries and their SQL."""

from . import corpus_queries, enrich_queries, lexicon_queries, records, search_queries, selection_queries, source_queries, text_queries

_MODULES = (records, corpus_queries, lexicon_queries, text_queries, search_queries, enrich_queries, selection_queries, source_queries)
FLAGSHIP = "top_bigrams"
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in _MODULES for name, sql in module.SQL.items()}
