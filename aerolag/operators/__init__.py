"""Joins, aggregations and iterative operators."""
