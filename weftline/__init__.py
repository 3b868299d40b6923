"""Lineage, quality and governance analytics as Spark DataFrame operators."""
