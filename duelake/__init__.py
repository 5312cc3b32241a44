"""Medallion analytics for two-sided contests, expressed as Spark DataFrames."""
