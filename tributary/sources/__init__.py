"""Readers, incremental pulls, the landing zone and the entity views over the given tables."""
