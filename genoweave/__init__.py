"""Interval, sequence and corpus analytics expressed as Spark DataFrame jobs."""
