"""The queries of this package, with their SQL where SQL can express them."""

from tidemark.llm.plans import matching, places, records, texts

MODULES = (matching, places, records, texts)
QUERIES = {name: fn for m in MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
