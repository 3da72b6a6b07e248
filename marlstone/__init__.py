"""marlstone: analytics operators for Spark, each a function from DataFrames to a DataFrame."""

from marlstone.session import build_session

__all__ = ["build_session"]
