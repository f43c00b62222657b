"""Hourly air and weather readings as Spark DataFrame jobs."""
