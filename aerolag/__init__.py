"""Spark-native analytics over on-time transport data.

Every public function takes DataFrames and returns a DataFrame, so jobs compose
and Catalyst sees one plan from scan to sink.
"""
