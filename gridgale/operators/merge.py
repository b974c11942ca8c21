"""Joining rain to weather, and the physical quantities derived from the joined table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridgale.functions import physics
from gridgale.functions.times import from_epoch_ns
from gridgale.grid import BBOX

# Columns of the joined table taken from the weather side, in order.
JOINED_WEATHER = [
    "step", "surface", "t2m", "d2m", "u10", "v10", "msl", "sst", "sp", "tcc", "tciw", "tclw",
]


def known_rain(rain: DataFrame) -> DataFrame:
    """Rain rows with a value; NaN counts as missing."""
    return rain.where(F.col("tp").isNotNull() & ~F.isnan("tp"))


def join_rain(rain: DataFrame, weather: DataFrame) -> DataFrame:
    """Rain valid at an instant meets the weather observed at that instant, cell by cell.

    Rain is a forecast: its own `time` is the issue time, so its `valid_time` is
    matched with the `time` of the weather. Both have as many rows, however small the files of the rain are, so it
    is merged by sort and never sent to all tasks.
    """
    r = known_rain(rain).select("latitude", "longitude", F.col("valid_time").alias("time"), "tp")
    w = weather.select("latitude", "longitude", "time", *JOINED_WEATHER)
    return r.hint("merge").join(w, ["latitude", "longitude", "time"], "inner").select(
        "latitude", "longitude", "time", *JOINED_WEATHER, "tp"
    )


def to_celsius(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: physics.kelvin_to_celsius(F.col(c)) for c in columns})


def merge_weather(rain: DataFrame, weather: DataFrame) -> DataFrame:
    """The joined table: instants instead of nanoseconds, temperatures in Celsius."""
    joined = join_rain(rain, weather).withColumn("time", from_epoch_ns(F.col("time")))
    return to_celsius(joined, "t2m", "d2m")


def inside(df: DataFrame, south: float, north: float, west: float, east: float) -> DataFrame:
    return df.where(F.col("latitude").between(south, north) & F.col("longitude").between(west, east))


def derive_physics(df: DataFrame) -> DataFrame:
    """Wind, vapor, humidity, felt temperature and air density of a Celsius table."""
    wind = physics.wind_speed(F.col("u10"), F.col("v10"))
    vapor = physics.vapor_pressure(F.col("d2m"))
    saturated = physics.vapor_pressure(F.col("t2m"))
    return df.withColumns(
        {
            "wind_speed": wind,
            "wind_direction": physics.wind_direction_closed(F.col("u10"), F.col("v10")),
            "vapor_pressure": vapor,
            "saturation_vapor_pressure": saturated,
            "relative_humidity": physics.relative_humidity(vapor, saturated),
            "apparent_temperature": physics.apparent_temperature(F.col("t2m"), vapor, wind),
            "air_density": physics.air_density(F.col("sp"), F.col("t2m")),
        }
    )


def weather_result(df: DataFrame) -> DataFrame:
    """The result table: derived quantities of the cells inside the default area."""
    return derive_physics(inside(df, **BBOX)).select(
        "time", "latitude", "longitude", "wind_speed", "vapor_pressure", "relative_humidity",
        "apparent_temperature", "air_density", "wind_direction",
    )


def dashboard_table(joined: DataFrame) -> DataFrame:
    """The serving table of the dashboard, from the joined Celsius table."""
    return joined.select(
        F.col("time").alias("valid_time"),
        "latitude",
        "longitude",
        F.col("t2m").alias("temperature_celsius"),
        physics.relative_humidity_exponential(F.col("d2m"), F.col("t2m")).alias("relative_humidity"),
        F.col("msl").alias("mean_sea_level_pressure"),
        physics.wind_speed(F.col("u10"), F.col("v10")).alias("wind_speed"),
        physics.kelvin_to_celsius(F.col("sst")).alias("sea_surface_temperature_celsius"),
        F.col("sp").alias("surface_pressure"),
        F.col("tcc").alias("total_cloud_cover"),
        F.col("tp").alias("total_precipitation"),
    )
