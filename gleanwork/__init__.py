"""Text retrieval and model selection on Spark DataFrames."""
