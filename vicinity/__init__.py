"""Vector search and embedding upkeep on Spark DataFrames."""
