"""Operators: DataFrames and column names in, a lazy DataFrame out."""
