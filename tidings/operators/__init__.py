"""Operators on DataFrames: places, severity, screening, duplicates, event merging, operations."""
