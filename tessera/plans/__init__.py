"""Whole pipelines, the query language, and the queries the driver runs."""
