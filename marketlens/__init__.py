"""Marketplace analytics on Spark: reusable DataFrame operators, functions, sources and query plans."""
