"""Operators on DataFrames. All are lazy; none collects."""
