"""Operators of a training-data pipeline over documents, pages and vectors.

Nothing outside this subpackage imports it; ``queries.py`` holds the thin
registered queries and ``corpus_pipeline.py`` at the repository top chains
five of the operators.
"""
