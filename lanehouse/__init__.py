"""Spark operators for the data side of running a data-producing facility."""
