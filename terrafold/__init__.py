"""Address and geo analytics on Spark DataFrames."""
