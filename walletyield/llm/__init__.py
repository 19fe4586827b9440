"""Operators of a training-data pipeline over documents, vectors and pages.

Self-contained: nothing else in the library imports this subpackage.
"""
