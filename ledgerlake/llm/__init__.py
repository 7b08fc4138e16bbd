"""Operators of a training-data pipeline over documents and web pages.

Nothing else in the library imports this subpackage. Every operator takes DataFrames, selects the columns it
needs by name (so further columns never clash) and treats a null text as an empty one.
"""
