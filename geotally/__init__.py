"""Regional time-series analytics on Spark DataFrames."""
