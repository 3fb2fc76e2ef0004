"""Operators for training-data pipelines (documents, pages, embeddings).

One module per operator; ``queries`` registers one query per operator.  Nothing
outside this package imports it, apart from the guarded registration in
``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
