"""Imports every query module so that all of them register."""

from workload import bronze_queries, gold_queries, job_queries, operator_queries, silver_queries, sink_queries  # noqa: F401
