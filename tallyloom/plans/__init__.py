"""Queries bound to the driver's tables, each paired with SQL where it exists."""

from tallyloom.plans.registry import ORACLES, QUERIES, load_all

__all__ = ["ORACLES", "QUERIES", "load_all"]
