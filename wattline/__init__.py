"""Interval-based electricity data (load, generation, day-ahead prices) on Spark."""
