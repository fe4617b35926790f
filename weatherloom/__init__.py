"""Station-observation analytics expressed as lazy Spark DataFrames."""
