"""Pipelines of steps, and the catalogue of queries with their SQL."""
