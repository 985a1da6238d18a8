"""Road-network trajectory analytics on Spark DataFrames."""
