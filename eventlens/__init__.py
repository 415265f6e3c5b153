"""eventlens: event-time window rules and topic analysis of short messages, on Spark."""

__version__ = "0.1.0"
