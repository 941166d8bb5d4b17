"""Catalogue-knowledge analytics expressed as Spark DataFrame operators."""
