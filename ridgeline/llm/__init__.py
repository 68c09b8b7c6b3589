"""Operators of a large-scale training-data pipeline, and their queries.

Nothing outside this folder, ``tests/llm``, ``corpus_pipeline.py`` and the
guarded import in ``__spark_entry__.py`` uses it.
"""
