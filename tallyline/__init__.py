"""Retail analytics on Spark: raw transactions to clean sales to business tables."""

__version__ = "0.1.0"
