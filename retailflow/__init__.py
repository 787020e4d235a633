"""Logs, orders and page views of online retail as Spark DataFrames, in batches and streams."""
