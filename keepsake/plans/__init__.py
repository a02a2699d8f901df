"""The retention tables: each step takes DataFrames and returns a DataFrame."""
