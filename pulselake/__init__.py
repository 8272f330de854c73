"""Medallion analytics for wearable and fitness events, written as plain Spark jobs."""
