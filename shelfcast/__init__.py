"""Daily product demand analytics on Spark DataFrames."""
