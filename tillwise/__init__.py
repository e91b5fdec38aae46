"""Retail sales analytics as Spark DataFrame jobs."""
