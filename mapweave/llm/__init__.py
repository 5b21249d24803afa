"""Operators for training-data pipelines over tables of documents and vectors.

Nothing else in the library imports this subpackage.  ``queries.py`` holds the
registered queries, every other module one operator or shared helpers.
"""
