"""Tick-data analytics on Spark: sources, operators, plans and streaming jobs."""
