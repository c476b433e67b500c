"""Operators for training-data corpora: documents, pages and embeddings.

Every operator works on any DataFrame and column names; the thin registered
queries over the test tables are in ``queries.py``, their SQL in ``oracle.py``.
"""
