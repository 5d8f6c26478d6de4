"""Time-series data-quality operators for environmental sensor data on Spark."""
