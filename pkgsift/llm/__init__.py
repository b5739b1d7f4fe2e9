"""Operators for building training corpora.

Ten operators (near-duplicate joins, quality rules, licence scans, mixing, chat
formatting, BPE, WARC, token files, toxicity) with the queries that apply them
to whole tables.  Nothing else in the library imports this subpackage.
"""
