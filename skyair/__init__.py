"""Spark operators for sensor readings and aircraft positions: land, clean, select, join, summarise."""

from skyair.session import build_session

__all__ = ["build_session"]
