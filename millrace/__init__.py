"""Flow-meter (and similar sensor) time-series analytics on Spark DataFrames."""
