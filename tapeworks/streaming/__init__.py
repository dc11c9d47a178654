"""Streaming of the tick-data engine."""
