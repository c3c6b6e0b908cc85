"""Document-collection analytics on Spark DataFrames."""
