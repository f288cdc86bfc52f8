"""Operators for preparing language-model training text on Spark.

Nothing else in the library imports this subpackage; the registered
queries are in ``queries.py`` and their DuckDB SQL in ``oracle.py``.
"""
