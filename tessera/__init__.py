"""Entity resolution, geospatial enrichment and property-graph analytics as Spark plans."""
