"""Reusable warehouse operators: DataFrames and explicit parameters in, DataFrames out."""
