"""Matching of names that arrive as a stream, against a fixed table; an extension, the reference data flow is batch only."""
