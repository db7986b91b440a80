"""Tradewind: batch retail analytics as PySpark DataFrame operators."""

from tradewind.session import build_session

__all__ = ["build_session"]
