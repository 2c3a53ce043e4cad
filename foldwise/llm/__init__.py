"""Operators of a training-data pipeline over text tables.

Nothing outside this package imports it.  Each module holds one operator with a general interface;
``queries`` registers the whole-table query of each.
"""
