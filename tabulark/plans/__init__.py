"""Composed builds: dimensions, facts, marts and the dds build order."""
