"""Code-instruction data preparation and code-evaluation analytics on Spark DataFrames."""
