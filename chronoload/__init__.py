"""Event logs to regular load series to forecasts, as Spark DataFrame jobs."""

__version__ = "0.1.0"
