"""Plans: the layer runs (Silver, Gold), the demo lineage and SQL views."""
