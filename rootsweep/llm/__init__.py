"""Training-data operators: one module per operator, queries in ``queries``.

Nothing outside this package imports it, except ``corpus_pipeline.py`` and the
guarded registration in ``__spark_entry__.py``.
"""
