"""Two-telescope event preparation on Spark DataFrames."""
