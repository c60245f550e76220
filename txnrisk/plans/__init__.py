"""Whole runs: the four stages, and the catalogue of queries over the test tables."""
