"""Operators for preparing training data: scans, scores, near-copies, archives, mixing and filters.

Every operator takes DataFrames and the names of the id and text columns, reads no other column, and returns
the id beside its own columns; filters return the input's columns unchanged.  Nulls, empty texts, repeated
rows, empty tables and extra columns have the result stated in each docstring.
"""
