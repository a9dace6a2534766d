"""Training-data operators: toxicity, packing, secret scans, near-dedup,
quality rules, PII pseudonyms, substring dedup, WARC archives, benchmark
decontamination and language identification.

Nothing outside this subpackage imports it.  ``queries.py`` holds the thin
registered queries, ``oracles.py`` the SQL that can express them.
"""
