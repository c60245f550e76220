"""The pipeline's steps, each a function from DataFrames to a DataFrame."""
