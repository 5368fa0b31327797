"""Event analytics on bounded and streaming DataFrames."""
