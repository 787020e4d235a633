"""Operators over DataFrames: enrichment, orders, indicators, joins, sinks, upkeep."""
