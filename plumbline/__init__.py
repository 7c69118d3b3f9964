"""Market-data evidence and research operators for Spark DataFrames."""
