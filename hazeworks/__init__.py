"""Monitoring analytics for environmental sensor readings, as Spark DataFrame operators."""
