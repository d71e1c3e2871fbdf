"""Reference and trade data on Spark: layered loads, quality rules and the tariff cube."""

from tradeloom.session import build_session

__all__ = ["build_session"]
