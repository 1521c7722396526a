"""Whole jobs, from input tables to result table."""
