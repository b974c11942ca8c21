"""Grouped reports."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridgale.functions import physics
from gridgale.functions.times import date_of, year_month_text
from gridgale.sources.readers import between_times


def daily_precipitation(df: DataFrame, time_column: str = "time") -> DataFrame:
    return (
        df.groupBy(date_of(F.col(time_column)).alias("date"))
        .agg(F.sum("tp").alias("total_precipitation"))
        .orderBy("date")
    )


def monthly_mean_temperature(df: DataFrame, time_column: str = "time") -> DataFrame:
    return (
        df.groupBy(F.year(time_column).alias("year"), F.month(time_column).alias("month"))
        .agg(F.avg("t2m").alias("avg_temperature"))
        .orderBy("year", "month")
    )


def temperature_and_humidity(df: DataFrame) -> DataFrame:
    """Celsius temperature beside relative humidity, from a Kelvin table."""
    t, d = physics.kelvin_to_celsius(F.col("t2m")), physics.kelvin_to_celsius(F.col("d2m"))
    known = df.where(F.col("t2m").isNotNull() & F.col("d2m").isNotNull())
    return known.select(
        t.alias("temperature_celsius"),
        physics.relative_humidity_exponential(d, t).alias("relative_humidity"),
    )


def humidity_report(df: DataFrame, time_column: str = "time") -> DataFrame:
    t, d = physics.kelvin_to_celsius(F.col("t2m")), physics.kelvin_to_celsius(F.col("d2m"))
    return df.select(
        "latitude",
        "longitude",
        F.col(time_column).alias("valid_time"),
        physics.relative_humidity_exponential(d, t).alias("relative_humidity"),
    ).orderBy("valid_time", "latitude", "longitude")


def wind_report(df: DataFrame, time_column: str = "time") -> DataFrame:
    u, v = F.col("u10"), F.col("v10")
    return df.select(
        "latitude",
        "longitude",
        F.col(time_column).alias("valid_time"),
        physics.wind_speed(u, v).alias("wind_speed"),
        physics.wind_direction(u, v).alias("wind_direction"),
    ).orderBy("valid_time", "latitude", "longitude")


def at_point(df: DataFrame, latitude: float, longitude: float) -> DataFrame:
    return df.where((F.col("latitude") == F.lit(latitude)) & (F.col("longitude") == F.lit(longitude)))


def in_year(df: DataFrame, year: int, time_column: str = "valid_time") -> DataFrame:
    """The year as a range of the bare column, so it reaches the files and the folders."""
    return between_times(df, datetime(year, 1, 1), datetime(year, 12, 31, 23, 59, 59, 999999), time_column)


def in_month(df: DataFrame, year: int, month: int, time_column: str = "valid_time") -> DataFrame:
    start = datetime(year, month, 1)
    after = datetime(year + month // 12, month % 12 + 1, 1)
    end = after - timedelta(microseconds=1)
    return between_times(df, start, end, time_column)


def point_daily(dashboard: DataFrame, latitude: float, longitude: float, year: int, month: int) -> DataFrame:
    """Highest and lowest temperature and rain of each day of one month at one cell."""
    rows = in_month(at_point(dashboard, latitude, longitude), year, month)
    return (
        rows.groupBy(date_of(F.col("valid_time")).alias("day"))
        .agg(
            F.max("temperature_celsius").alias("max_temperature"),
            F.min("temperature_celsius").alias("min_temperature"),
            F.sum("total_precipitation").alias("total_precipitation"),
        )
        .orderBy("day")
    )


def point_monthly(dashboard: DataFrame, latitude: float, longitude: float, year: int) -> DataFrame:
    """Month extremes, widest daily range and rain of one year at one cell."""
    t = F.col("temperature_celsius")
    daily = (
        in_year(at_point(dashboard, latitude, longitude), year)
        .groupBy(date_of(F.col("valid_time")).alias("day"))
        .agg(
            F.max(t).alias("high"),
            F.min(t).alias("low"),
            (F.max(t) - F.min(t)).alias("spread"),
            F.sum("total_precipitation").alias("rain"),
        )
    )
    return (
        daily.groupBy(year_month_text(F.col("day")).alias("month"))
        .agg(
            F.max("high").alias("max_temperature"),
            F.min("low").alias("min_temperature"),
            F.max("spread").alias("max_daily_difference"),
            F.sum("rain").alias("rain"),
        )
        .orderBy("month")
    )


def storms_by_month(storms: DataFrame, exclude_placeholder: bool = True) -> DataFrame:
    """Distinct storms per month; a storm that crosses months counts in each.

    Quiet hours carry an id ending in `-00`; the raw count takes it for a storm.
    """
    if exclude_placeholder:
        storms = storms.where(~F.col("id").endswith("-00"))
    pairs = storms.select("id", year_month_text(F.col("time")).alias("month")).distinct()
    return pairs.groupBy("month").agg(F.count(F.lit(1)).alias("storms"))


def all_months(counts: DataFrame, years: DataFrame) -> DataFrame:
    """Twelve rows for each of `years`; months without storms count 0."""
    calendar = years.select("year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("m")).select(
        F.format_string("%04d-%02d", F.col("year"), F.col("m")).alias("month")
    )
    return (
        calendar.join(counts, "month", "left")
        .select("month", F.coalesce("storms", F.lit(0).cast("long")).alias("storms"))
        .orderBy("month")
    )


def share_of_rain(report: DataFrame, rain: str, within: Column) -> DataFrame:
    """Add each row's part of the rain of its pie; rows of one `within` make one pie."""
    total = F.sum(rain).over(Window.partitionBy(within))
    return report.withColumn("share", F.try_divide(F.col(rain), total))


def value_ticks(df: DataFrame, column: str, ticks: int = 7) -> DataFrame:
    """Lowest and highest value, and whole-number marks spread evenly from one to the other."""
    span = df.agg(F.min(column).alias("low"), F.max(column).alias("high"))
    step = (F.col("high") - F.col("low")) / F.lit(float(ticks - 1))
    marks = F.transform(
        F.sequence(F.lit(0), F.lit(ticks - 1)),
        lambda i: F.floor(
            F.when(i == ticks - 1, F.col("high")).otherwise(F.col("low") + i * step)
        ),
    )
    return span.withColumn("ticks", marks)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table, in one job."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        for name, df in tables.items()
    ]
    first, *rest = counted
    for one in rest:
        first = first.unionByName(one)
    return first


def frame_means(df: DataFrame, column: str) -> DataFrame:
    """Mean of each frame over the cells that have a value."""
    known = F.when(~F.isnan(column), F.col(column))
    return df.groupBy("time").agg(F.avg(known).alias("mean"), F.count(known).alias("known"))
