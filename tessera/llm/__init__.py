"""Operators for training data on the tables of documents and embeddings, with their queries.

Nothing outside this package imports it.
"""
