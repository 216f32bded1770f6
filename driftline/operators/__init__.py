"""The analyses, as functions from DataFrames to DataFrames."""
