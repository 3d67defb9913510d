"""Hourly demand series and forecast backtests as Spark DataFrame operators."""

from hourgrid.session import build_session, configure, cut_lineage

__all__ = ["build_session", "configure", "cut_lineage"]
