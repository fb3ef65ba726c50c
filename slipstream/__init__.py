"""On-time-performance, capacity and what-if analytics for transport operations on Spark."""

__version__ = "0.1.0"
