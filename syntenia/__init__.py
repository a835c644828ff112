"""Gene-annotation transfer analytics on Spark DataFrames."""
