"""factgraph: typed fact graphs as plain PySpark DataFrame operators."""

from factgraph.session import build_session

__all__ = ["build_session"]
