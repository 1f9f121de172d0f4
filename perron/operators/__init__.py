"""Relational operators on DataFrames, independent of any dataset."""
