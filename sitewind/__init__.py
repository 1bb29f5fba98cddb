"""Analytics for wind measurements taken at many sites, written on Spark DataFrames."""
