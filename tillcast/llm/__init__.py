"""Operators of a training-data pipeline over documents, pages and embeddings.

Each module holds one operator with its own interface; ``queries`` derives the
registered ``opN_<name>`` digests from them.  Nothing else in the library
imports this package.
"""
