"""Operators for preparing text corpora for training.

Nothing else in the library imports this subpackage; ``queries`` maps the
registered queries and ``corpus_pipeline`` (repository top) chains five of
the operators.
"""
