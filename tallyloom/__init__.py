"""Retail sales analytics as Spark jobs: clean, check, load, model, report."""
