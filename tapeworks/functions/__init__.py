"""Functions of the tick-data engine."""
