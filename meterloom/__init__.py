"""Sensor and meter analytics as DataFrame-to-DataFrame Spark transforms."""
