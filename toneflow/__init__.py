"""toneflow: daily tone metrics for financial news, expressed as Spark jobs."""

__version__ = "0.1.0"
