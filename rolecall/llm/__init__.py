"""Operators of a large training-data pipeline over documents.

Nothing outside this folder imports it. Where a docstring says nothing else, a null
text is an empty text, rows that repeat are rows of their own, an empty table gives
an empty result, and columns that an operator does not name are left alone.
"""
