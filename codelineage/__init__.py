"""Release history of source-code repositories as Spark DataFrames."""
