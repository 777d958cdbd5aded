"""Operators of a training-data pipeline, their queries and their oracle SQL.

Nothing outside this package imports it but ``__spark_entry__.py`` (guarded)
and ``corpus_pipeline.py``.
"""
