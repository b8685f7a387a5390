"""Layered retail analytics (raw, curated, discovery, outbound) as Spark DataFrame operators."""

__version__ = "0.1.0"
