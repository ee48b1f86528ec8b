"""Document-indexing analytics on Spark DataFrames."""
