"""Operators for large training-data tables, and the queries that apply them.

Nothing else in the library imports this package; ``__spark_entry__.py`` adds
its queries when it is there.
"""
