"""Street-flow and frontage-visibility analytics on Spark DataFrames."""
