"""Registration of queries: the function's name is the key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Engines differ in the last digits of sums and powers."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in columns})
