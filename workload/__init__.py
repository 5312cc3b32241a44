"""Runs every operator over the given tables and states the expected results in SQL."""
