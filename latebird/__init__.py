"""Batch flight-delay analytics and delay prediction on Apache Spark."""

__version__ = "0.1.0"
