"""Whole queries over tables, and the same queries in SQL."""
