"""Snapshot ingestion, quality and mart building as Spark DataFrame jobs."""

__version__ = "0.1.0"
