"""Scoring and review-routing analytics as PySpark DataFrame operators."""
