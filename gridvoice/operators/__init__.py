"""Business operators: pure functions from DataFrames to DataFrames."""
