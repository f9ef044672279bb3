"""Web-log and order analytics on Spark DataFrames, Spark SQL and Structured Streaming."""
