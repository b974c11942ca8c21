"""Gridded weather analytics on Spark DataFrames."""

from gridgale.grid import GridSpec, VIETNAM_GRID
from gridgale.session import get_session

__all__ = ["GridSpec", "VIETNAM_GRID", "get_session"]
