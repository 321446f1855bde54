"""The data products. Each is a function from DataFrames to a DataFrame."""
