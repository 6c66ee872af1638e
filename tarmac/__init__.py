"""Spark analytics for event tables of an operations network."""
