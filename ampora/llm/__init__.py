"""Operators of a training-data pipeline: search, tokens, archives, filters, deduplication.

Nothing outside this subpackage, ``corpus_pipeline.py`` and the guarded part of
``__spark_entry__.py`` imports it.
"""
