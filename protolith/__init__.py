"""Protein-annotation analytics as Spark DataFrame jobs."""
