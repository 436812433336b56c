"""Operators of a training-data pipeline, one module per operator.

Each module has the operator with a general interface (a DataFrame in, a
DataFrame out, columns named by arguments) and a thin ``opN_*`` query that
applies it to its whole table with production parameters. ``queries.py``
collects the queries and their DuckDB twins.
"""
