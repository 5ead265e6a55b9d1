"""Operators for preparing language-model training data.

Nothing else in the library imports this package; ``queries.py`` lists its
registered queries and ``corpus_pipeline.py`` (repository top) chains five of
the operators into a pipeline.
"""
