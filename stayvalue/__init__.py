"""Customer value (recency, frequency, monetary) analysis on Spark."""
