"""Ball-by-ball analytics on Spark: the same metrics as batch queries and as streams."""
