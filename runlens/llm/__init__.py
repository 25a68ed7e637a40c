"""Training-data operators: sharding, token files, dedup, filters, mixing, extraction.

Nothing outside this package imports it, except the guarded registration in
``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
