"""Whole jobs, and the query catalogue run over the given tables."""
