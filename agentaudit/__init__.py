"""Audit analytics over agent traces, written as PySpark DataFrame jobs."""
