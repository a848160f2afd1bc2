"""Spark jobs for archives of JSON activity events: raw lines to layered tables, metrics and clusters."""
