"""Operators for preparing training data at scale (documents, pages, embeddings).

Nothing outside this package and ``corpus_pipeline.py`` imports it.
"""
