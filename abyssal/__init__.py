"""Benthic-chamber time-series analytics as PySpark jobs over many deployments at once."""
