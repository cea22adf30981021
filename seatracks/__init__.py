"""Ship-position analytics on Spark DataFrames."""
