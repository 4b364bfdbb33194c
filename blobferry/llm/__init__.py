"""Operators of a training-data pipeline, each a set of DataFrame functions.

Nothing else in the library imports this subpackage. Its registered queries
are in ``queries.py``; ``corpus_pipeline.py`` at the repository top chains
five of the operators.
"""
