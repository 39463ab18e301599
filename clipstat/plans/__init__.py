"""Plans: pipelines composed from operators, fixtures and the query registry."""
