"""Training-data operators: fingerprints, toxicity, packing, near and substring
deduplication, quality rules, token-count rollups, licence scans, piece encoding and URL
filters. Nothing else in the library imports this subpackage; its queries and their SQL
are in ``queries.py``."""
