"""Plans of the tick-data engine."""
