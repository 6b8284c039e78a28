"""Operators of a training-data pipeline over document, page and label tables.

One module per operator; ``queries.py`` registers one query each.  Nothing
outside this subpackage imports it.
"""
