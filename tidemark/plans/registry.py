"""All queries of the core, with their SQL."""

from __future__ import annotations

from tidemark.plans import data_queries, linkage, pipelines, relational, retrieval, scalars, statements

MODULES = (data_queries, relational, scalars, linkage, retrieval, statements, pipelines)
FLAGSHIP = "q_score_pairs_fixed_model"


def queries() -> dict:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
