"""Sources of the tick-data engine."""
