"""Fleet telemetry analytics on Spark: ingestion, graph risk, scoring, routing and serving."""

__version__ = "0.2.0"
