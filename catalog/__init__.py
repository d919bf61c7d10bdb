"""Registered queries and the DuckDB SQL that has to give the same rows."""

from catalog import cluster_queries, model_queries, retrieval_queries, table_queries

_MODULES = (retrieval_queries, table_queries, cluster_queries, model_queries)

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
