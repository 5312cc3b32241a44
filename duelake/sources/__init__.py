"""Readers for landed JSON, bronze datasets and catalog tables."""
