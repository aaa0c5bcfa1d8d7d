"""Queries of the operators in this subpackage, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

from runledger.llm import query_ann, query_decontam, query_negatives, query_packing, query_pages, query_pieces, query_pii, query_quality, query_ranked, query_secrets, query_shards, query_simhash, query_tokens

MODULES = (query_shards, query_ann, query_pages, query_tokens, query_decontam, query_pieces, query_quality, query_pii, query_secrets, query_simhash, query_ranked, query_negatives, query_packing)

QUERIES = {name: fn for m in MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in getattr(m, "ORACLE", {}).items()}
