"""Operators of the tick-data engine."""
