"""Relational, matching, spatial and graph operators over DataFrames."""
