"""Spark-native operators for the data side of a machine-learning workflow."""

from tallyloom.session import build_session

__all__ = ["build_session"]
__version__ = "0.1.0"
