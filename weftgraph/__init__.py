"""Lineage extraction and lineage analytics as PySpark jobs."""
