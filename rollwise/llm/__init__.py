"""Operators for large-scale training-data preparation (one module per operator).

Nothing else in the library imports this subpackage; ``queries`` holds the named
queries built from it.
"""
