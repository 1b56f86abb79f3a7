"""Operators of a training-data pipeline over tables of documents and vectors.

Nothing else in the package imports this one.
"""
