"""Table reads, writes and the plant-shaped views over the given tables."""
