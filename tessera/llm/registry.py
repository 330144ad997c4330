"""All queries of this package by name, and their SQL."""

from tessera.llm import fingerprints, mixing, ngram_join, packing, quality, secrets, sharding, suffixes, topk, warc

MODULES = (ngram_join, sharding, warc, mixing, packing, quality, secrets, fingerprints, topk, suffixes)
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
SQL = {k: f for m in MODULES for k, f in m.SQL.items()}
