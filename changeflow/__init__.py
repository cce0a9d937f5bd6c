"""Change-data-capture operators for Spark DataFrames and Structured Streaming."""
