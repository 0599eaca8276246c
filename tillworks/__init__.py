"""Retail and delivery analytics as Spark DataFrame operators."""
