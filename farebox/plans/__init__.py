"""Models: plain functions from DataFrames to DataFrames, composed so that Spark plans each query as a whole."""
