"""Training-data operators on Spark: quality, dedup, search, mixing, tokens."""
