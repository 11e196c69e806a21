"""Tabular profiling, testing, preparation and scoring expressed as Spark plans."""

__version__ = "0.1.0"
