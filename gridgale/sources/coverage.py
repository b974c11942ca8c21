"""Which hours a table should hold, and which of them it lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hours_between(bounds: DataFrame, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """Every hour of every day between two date columns.

    Days come from one explode and hours from a second, after the days are spread
    out, so a long calendar does not unroll inside a single row.
    """
    days = bounds.select(F.explode(F.sequence(F.col(first), F.col(last), F.expr("INTERVAL 1 DAY"))).alias("day"))
    return days.repartition("day").select(
        F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"), "day"
    ).select(
        F.timestamp_add("HOUR", F.col("hour"), F.col("day").cast("timestamp_ntz")).alias("time")
    )


def day_bounds(df: DataFrame, time: Column) -> DataFrame:
    return df.agg(F.to_date(F.min(time)).alias("first_day"), F.to_date(F.max(time)).alias("last_day"))


def missing_hours(df: DataFrame, time_column: str = "time", bounds: DataFrame | None = None) -> DataFrame:
    """Hours of the covered days for which the table has no row: the backfill list."""
    present = df.select(F.col(time_column).alias("time")).distinct()
    expected = hours_between(bounds if bounds is not None else day_bounds(df, F.col(time_column)))
    return expected.join(present, "time", "left_anti")
