"""Person-by-month feature panels and model selection on Spark DataFrames."""
