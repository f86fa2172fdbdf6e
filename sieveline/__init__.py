"""Title-rule screening and data-processing operators on Spark DataFrames."""
