"""Sieveline: DataFrame operators for curating, deduplicating, splitting and
evaluating large record collections on Spark."""

__version__ = "0.1.0"
