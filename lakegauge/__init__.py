"""Telemetry lake analytics on Spark: raw, clean and KPI layers, serving tables."""

__version__ = "0.1.0"
