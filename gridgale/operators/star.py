"""The star schema: one fact table and three dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridgale.functions.keys import location_key, observation_id, row_id
from gridgale.functions.times import calendar_parts, from_epoch_ns

# Labels of dimensions that the raw data does not fill, and fact names.
UNKNOWN_REGION = "Unknown Region"
UNKNOWN = "Unknown"
CONDITION_LABELS = ["weather_type", "wind_category", "cloud_cover_category"]
FACT_NAMES = {
    "u10": "u_wind",
    "v10": "v_wind",
    "d2m": "dewpoint_temp",
    "t2m": "air_temp",
    "msl": "mean_sea_level_pressure",
    "sst": "sea_surface_temp",
    "sp": "surface_pressure",
    "tcc": "total_cloud_cover",
    "tciw": "cloud_ice_water_content",
    "tclw": "cloud_liquid_water_content",
}


def _labels(weather: DataFrame) -> list[Column]:
    """The labels of an observation's condition; those that the table lacks, or has no value for, are unknown."""
    unknown = F.lit(UNKNOWN)
    return [(F.coalesce(F.col(n), unknown) if n in weather.columns else unknown).alias(n) for n in CONDITION_LABELS]


def fact(weather: DataFrame) -> DataFrame:
    """One row per observation; `weather_id` points at its condition."""
    return weather.select(
        observation_id(F.col("time"), F.col("latitude"), F.col("longitude")).alias("fact_id"),
        F.col("time").alias("time_id"),
        location_key(F.col("latitude"), F.col("longitude")).alias("location_id"),
        row_id(*_labels(weather)).alias("weather_id"),
        *[F.col(raw).alias(name) for raw, name in FACT_NAMES.items()],
    )


def time_dimension(weather: DataFrame) -> DataFrame:
    """Distinct first, calendar after: only the long crosses the shuffle."""
    ids = weather.select(F.col("time").alias("time_id")).distinct()
    dated = ids.withColumn("time", from_epoch_ns(F.col("time_id")))
    return dated.select("time_id", "time", *[c.alias(n) for n, c in calendar_parts(F.col("time")).items()])


def location_dimension(weather: DataFrame) -> DataFrame:
    cells = weather.select("latitude", "longitude").distinct()
    return cells.select(
        location_key(F.col("latitude"), F.col("longitude")).alias("location_id"),
        "latitude",
        "longitude",
        F.lit(UNKNOWN_REGION).alias("region"),
    )


def condition_dimension(weather: DataFrame) -> DataFrame:
    """The conditions that the table has: distinct labels first, their key after."""
    labels = weather.select(*_labels(weather)).distinct()
    return labels.select(row_id(*[F.col(n) for n in CONDITION_LABELS]).alias("weather_id"), *CONDITION_LABELS)


def split(weather: DataFrame) -> dict[str, DataFrame]:
    """The four tables by name."""
    return {
        "fact_weather_measurements": fact(weather),
        "dim_time": time_dimension(weather),
        "dim_location": location_dimension(weather),
        "dim_weather_conditions": condition_dimension(weather),
    }


def read_back(tables: dict[str, DataFrame]) -> DataFrame:
    """Facts with their dimensions; which of these are broadcast is left to measured sizes."""
    return (
        tables["fact_weather_measurements"]
        .join(tables["dim_time"], "time_id")
        .join(tables["dim_location"], "location_id")
        .join(tables["dim_weather_conditions"], "weather_id")
    )
