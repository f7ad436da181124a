"""Retail-banking analytics as Spark DataFrame transformations."""

from tellermill.bank import Bank

__all__ = ["Bank"]
