"""Operators of a training-data pipeline.

Nothing else in the package imports this subpackage.  Each module holds one
operator with a general interface; ``queries`` holds the thin registered
queries that apply the operators to whole tables.
"""
