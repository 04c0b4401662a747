"""Operators that prepare text for language-model training.

Nothing outside this folder imports it. Each operator takes and returns DataFrames; ``queries``
holds the registered queries over the generic tables.
"""
