"""kgspark: knowledge-graph analytics on Spark DataFrames of quads."""
