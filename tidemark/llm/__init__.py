"""Operators of a training-data pipeline over a table of documents.

Nothing outside this package imports it. Each module is one operator; ``workload`` registers the queries.
"""
