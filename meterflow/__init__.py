"""meterflow: electricity-meter analytics as Spark DataFrame, SQL and Structured
Streaming operators (billing, alerts, dashboard reads, daily series, forecast)."""

__version__ = "0.1.0"
