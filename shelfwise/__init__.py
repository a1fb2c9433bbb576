"""Retail price and ranking analytics as Spark DataFrame jobs."""

from shelfwise.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
