"""Operators for building training data from text at scale.

Nothing else in the library imports this subpackage.  ``registry`` lists the
queries and their DuckDB SQL; ``corpus_pipeline.py`` at the repository top
chains five of the operators.
"""
