"""The pipeline's models and jobs as functions from DataFrames to DataFrames."""
