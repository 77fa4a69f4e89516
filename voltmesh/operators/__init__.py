"""Set-based operators: plain functions from DataFrames to DataFrames."""
