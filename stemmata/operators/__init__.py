"""Operators on editions: DataFrames in, DataFrames out."""
