"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Tables have the columns doc_id and text; further columns are carried along where an
operator returns rows of its input. Its result columns replace input columns of the same
name; names that start with two underscores are reserved.
"""
