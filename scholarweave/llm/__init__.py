"""Operators of a training-data pipeline over the tables documents, benchmark, labels and pages.

Nothing else in the library imports this package; it imports only general helpers.
"""
