"""News-text analytics on Spark DataFrames."""
