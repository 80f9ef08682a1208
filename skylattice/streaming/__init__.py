"""Scene folders as a stream."""
