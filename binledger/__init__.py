"""binledger: billing, pricing and campaign analytics as Spark DataFrame jobs."""

__version__ = "0.1.0"
