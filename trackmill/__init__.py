"""Issue and change-log analytics on Spark DataFrames."""
