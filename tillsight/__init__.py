"""Insights over a feed of e-commerce transactions, as PySpark jobs."""
