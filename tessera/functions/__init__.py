"""Column functions: names and texts, similarity scores, vocabularies."""
