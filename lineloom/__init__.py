"""Metadata inventory, catalog entities and script lineage as Spark jobs."""
