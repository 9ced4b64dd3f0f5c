"""Hydro-meteorological time-series analytics as Spark DataFrame operators."""
