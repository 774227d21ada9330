"""Operators of a training-data pipeline: ten jobs over documents, embeddings and pages.

Nothing outside this subpackage imports it. `queries.py` holds the registered queries.
"""
