"""Batch-versioned warehouse operators on Spark DataFrames."""
