"""Operators of a training-data pipeline; nothing else in the library imports this package.

Each module holds one operator with its own general interface; ``queries`` applies the operators
to the provided tables and derives the digest columns of the registered queries.
"""
