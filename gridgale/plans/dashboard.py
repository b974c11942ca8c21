"""The dashboard's queries, with typed parameters."""

from __future__ import annotations

from datetime import date, datetime, time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridgale.functions.physics import rain_millimetres
from gridgale.functions.times import year_month_text
from gridgale.operators import reports, windows
from gridgale.sources.readers import between_times, raster_order

# Measures of the serving table, in display order.
ATTRIBUTES = [
    "temperature_celsius", "relative_humidity", "mean_sea_level_pressure", "wind_speed",
    "sea_surface_temperature_celsius", "surface_pressure", "total_cloud_cover", "total_precipitation",
]


def _day(day: date) -> tuple[datetime, datetime]:
    """From midnight to the last microsecond."""
    return datetime.combine(day, time.min), datetime.combine(day, time.max)


def day_frames(dashboard: DataFrame, day: date) -> DataFrame:
    """All measures of one day in raster order: one scan, whatever is shown."""
    rows = between_times(dashboard, *_day(day), "valid_time")
    return raster_order(rows.select("valid_time", "latitude", "longitude", *ATTRIBUTES), "valid_time")


def day_storms(storms: DataFrame, day: date) -> DataFrame:
    return between_times(storms, *_day(day)).orderBy("time")


def day_segments(hourly: DataFrame, day: date) -> DataFrame:
    return windows.daily_segments(between_times(hourly, *_day(day)))


def year_page(dashboard: DataFrame, latitude: float, longitude: float, year: int) -> DataFrame:
    """Month report with rain in millimetres and each month's share of its year."""
    months = reports.point_monthly(dashboard, latitude, longitude, year)
    wet = months.withColumn("rain", rain_millimetres(F.col("rain")))
    return reports.share_of_rain(wet, "rain", F.substring("month", 1, 4)).orderBy("month")


def month_page(dashboard: DataFrame, latitude: float, longitude: float, year: int, month: int) -> DataFrame:
    """Day report with rain in millimetres and each day's share of its month."""
    days = reports.point_daily(dashboard, latitude, longitude, year, month)
    wet = days.withColumn("total_precipitation", rain_millimetres(F.col("total_precipitation")))
    return reports.share_of_rain(wet, "total_precipitation", year_month_text(F.col("day"))).orderBy("day")


def storms_of_year(storms: DataFrame, year: int, exclude_placeholder: bool = True) -> DataFrame:
    """Storm count of each of the twelve months."""
    counts = reports.storms_by_month(reports.in_year(storms, year, "time"), exclude_placeholder)
    years = storms.sparkSession.range(1).select(F.lit(year).alias("year"))
    return reports.all_months(counts, years)
