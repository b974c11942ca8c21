"""Projections, filters, sorts and set operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridgale.functions import geo, keys, physics, times
from gridgale.grid import BBOX
from gridgale.operators import merge, reports, star
from gridgale.operators.windows import next_to_previous, previous_cells, strong_wind
from gridgale.sources import readers, sinks
from gridgale.streaming.feed import parse_messages
from registry import fixture as fx
from registry.catalog import longs, query, rounded

KEYS = ["time", "latitude", "longitude"]


def _with(spark: SparkSession, sf: str, **columns) -> DataFrame:
    """Keys of every observation with the given computed columns."""
    return fx.grid(spark, sf).select(*KEYS, *[c.alias(n) for n, c in columns.items()])


def _celsius(name: str):
    return physics.kelvin_to_celsius(F.col(name))


@query
def prj1_joined_projection(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(merge.join_rain(fx.rain(spark, sf), fx.weather(spark, sf)), 4, "msl", "t2m", "d2m", "sst", "u10", "v10", "tcc")


@query
def prj2_epoch_to_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    r = fx.rain(spark, sf)
    return r.select(
        F.col("time").alias("time_ns"), times.from_epoch_ns(F.col("time")).alias("time"),
        times.from_epoch_ns(F.col("valid_time")).alias("valid_time"), "latitude", "longitude",
    )


@query
def prj3_kelvin_to_celsius(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(merge.to_celsius(fx.grid(spark, sf).select(*KEYS, "t2m", "d2m"), "t2m", "d2m"), 6, "t2m", "d2m")


@query
def prj4_wind_speed(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_with(spark, sf, wind_speed=physics.wind_speed(F.col("u10"), F.col("v10"))), 6, "wind_speed")


@query
def prj5_wind_direction_closed(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        _with(spark, sf, wind_direction=physics.wind_direction_closed(F.col("u10"), F.col("v10"))), 6, "wind_direction"
    )


@query
def prj6_wind_direction(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_with(spark, sf, wind_direction=physics.wind_direction(F.col("u10"), F.col("v10"))), 6, "wind_direction")


@query
def prj7_vapor_pressure(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_with(spark, sf, vapor_pressure=physics.vapor_pressure(_celsius("d2m"))), 6, "vapor_pressure")


@query
def prj8_saturation_vapor_pressure(spark: SparkSession, sf: str) -> DataFrame:
    p = physics.vapor_pressure(_celsius("t2m"))
    return rounded(_with(spark, sf, saturation_vapor_pressure=p), 6, "saturation_vapor_pressure")


@query
def prj9_relative_humidity(spark: SparkSession, sf: str) -> DataFrame:
    h = physics.relative_humidity(physics.vapor_pressure(_celsius("d2m")), physics.vapor_pressure(_celsius("t2m")))
    return rounded(_with(spark, sf, relative_humidity=h), 6, "relative_humidity")


@query
def prj10_relative_humidity_exponential(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reports.humidity_report(fx.grid(spark, sf)), 6, "relative_humidity")


@query
def prj10_temperature_and_humidity(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reports.temperature_and_humidity(fx.grid(spark, sf)), 6, "temperature_celsius", "relative_humidity")


@query
def prj11_apparent_temperature(spark: SparkSession, sf: str) -> DataFrame:
    a = physics.apparent_temperature(
        _celsius("t2m"), physics.vapor_pressure(_celsius("d2m")), physics.wind_speed(F.col("u10"), F.col("v10"))
    )
    return rounded(_with(spark, sf, apparent_temperature=a), 6, "apparent_temperature")


@query
def prj12_air_density(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_with(spark, sf, air_density=physics.air_density(F.col("sp"), _celsius("t2m"))), 8, "air_density")


@query
def prj13_calendar_parts(spark: SparkSession, sf: str) -> DataFrame:
    c = fx.climate(spark, sf)
    parts = times.calendar_parts(F.col("time"))
    return c.select(*KEYS, *[p.cast("long").alias(n) for n, p in parts.items()])


@query
def prj14_calendar_texts(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("time")
    return fx.climate(spark, sf).select(
        *KEYS, times.date_of(t).alias("date"), times.year_month_text(t).alias("month"), times.year_text(t).alias("year")
    )


@query
def prj15_location_key(spark: SparkSession, sf: str) -> DataFrame:
    return _with(spark, sf, location_id=keys.location_key(F.col("latitude"), F.col("longitude")))


@query
def prj16_row_ids(spark: SparkSession, sf: str) -> DataFrame:
    """The packed ids themselves."""
    return fx.weather(spark, sf).select("latitude", "longitude", keys.observation_id(*[F.col(c) for c in KEYS]).alias("id"))


@query
def prj17_fact_projection(spark: SparkSession, sf: str) -> DataFrame:
    f = star.fact(fx.weather(spark, sf)).drop("fact_id", "weather_id")
    return rounded(f, 4, *star.FACT_NAMES.values())


@query
def prj18_rain_millimetres(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_with(spark, sf, rain_mm=physics.rain_millimetres(F.col("tp"))), 6, "rain_mm")


@query
def prj19_parse_messages(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_messages(sinks.to_messages(fx.observations(spark, sf)))
    return parsed_form(parsed)


def parsed_form(parsed: DataFrame) -> DataFrame:
    """Parsed messages with their floats widened for comparison."""
    floats = [n for n, t in parsed.dtypes if t in ("float", "double")]
    wide = parsed.withColumns({c: F.round(F.col(c).cast("double"), 4) for c in floats})
    return longs(wide, "number")


@query
def prj20_grid_index(spark: SparkSession, sf: str) -> DataFrame:
    lat, lon = F.col("latitude"), F.col("longitude")
    return _with(spark, sf, iy=fx.SPEC.iy(lat).cast("long"), ix=fx.SPEC.ix(lon).cast("long"))


def _to_point(radius: float):
    return geo.distance_km(F.col("longitude"), F.col("latitude"), F.lit(107.0), F.lit(16.0), radius)


@query
def prj21_distance(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_with(spark, sf, km=_to_point(geo.RADIUS_TRACKS)), 5, "km")


@query
def prj22_extent_distance(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_with(spark, sf, km=_to_point(geo.RADIUS_EXTENT)), 5, "km")


@query
def prj23_planar_distance(spark: SparkSession, sf: str) -> DataFrame:
    d = geo.planar_distance(F.col("longitude"), F.col("latitude"), F.lit(107.0), F.lit(16.0))
    return rounded(_with(spark, sf, degrees=d), 8, "degrees")


@query
def prj24_degree_lengths(spark: SparkSession, sf: str) -> DataFrame:
    lon = geo.degree_of_longitude_km(F.col("latitude"))
    return rounded(_with(spark, sf, lon_km=lon, lat_km=F.lit(geo.KM_PER_DEG_LAT)), 8, "lon_km")


@query
def prj25_shapes(spark: SparkSession, sf: str) -> DataFrame:
    area = geo.region_area_km2(F.lit(9), F.col("latitude"), 0.25, 0.25)
    ratio = (F.col("tcc") + F.lit(0.01)) / F.lit(1.02)
    shapes = _with(
        spark, sf,
        diameter=geo.equal_area_diameter(area),
        major_from_ratio=geo.major_axis_from_ratio(area, ratio),
        eccentricity=geo.eccentricity_from_ratio(ratio),
        major_from_ecc=geo.major_axis_from_eccentricity(area, geo.eccentricity_from_ratio(ratio)),
    )
    return rounded(shapes, 6, "diameter", "major_from_ratio", "eccentricity", "major_from_ecc")


@query
def prj26_storm_name(spark: SparkSession, sf: str) -> DataFrame:
    g = fx.grid(spark, sf)
    return g.select(*KEYS, keys.storm_name(F.date_format("time", "yyyy"), F.col("frame")).alias("id"))


@query
def prj27_nearest_quarter(spark: SparkSession, sf: str) -> DataFrame:
    halfway, between = F.col("latitude") + F.lit(0.125), F.col("longitude") + F.col("tcc")
    return _with(spark, sf, tie=geo.nearest_quarter(halfway), quarter=geo.nearest_quarter(between))


@query
def prj28_display_row(spark: SparkSession, sf: str) -> DataFrame:
    return _with(spark, sf, row=geo.display_row(F.col("iy"), fx.SPEC.ny).cast("long"))


@query
def prj29_constant_labels(spark: SparkSession, sf: str) -> DataFrame:
    return _with(
        spark, sf, region=F.lit(star.UNKNOWN_REGION), **{c: F.lit(star.UNKNOWN) for c in star.CONDITION_LABELS}
    )


@query
def prj30_dashboard_table(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        fx.dashboard(spark, sf), 4, "temperature_celsius", "relative_humidity", "mean_sea_level_pressure",
        "wind_speed", "sea_surface_temperature_celsius",
    )


@query
def flt1_known_rain(spark: SparkSession, sf: str) -> DataFrame:
    return merge.known_rain(fx.rain(spark, sf)).select("valid_time", "latitude", "longitude", "tp")


@query
def flt2_default_area(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(merge.inside(fx.grid(spark, sf).select(*KEYS, "t2m"), **BBOX), 6, "t2m")


@query
def flt2_small_area(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(merge.inside(fx.grid(spark, sf).select(*KEYS, "t2m"), 20.0, 23.0, 102.5, 105.0), 6, "t2m")


@query
def flt3_time_range(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.grid(spark, sf).select(*KEYS, "sp")
    return readers.between_times(rows, "2024-01-01 06:00:00", "2024-01-02 18:00:00")


@query
def flt4_point_and_month(spark: SparkSession, sf: str) -> DataFrame:
    at = reports.at_point(fx.climate_dashboard(spark, sf), 22.0, 104.0)
    rows = reports.in_month(at, 2024, 1)
    return rounded(rows.select("valid_time", "latitude", "longitude", "temperature_celsius"), 6, "temperature_celsius")


@query
def flt5_known_temperatures(spark: SparkSession, sf: str) -> DataFrame:
    """Sea temperature stands in for the dew point, which is never missing here."""
    g = fx.grid(spark, sf).select(F.col("sst").alias("d2m"), "t2m")
    return rounded(reports.temperature_and_humidity(g), 6, "temperature_celsius", "relative_humidity")


@query
def flt6_strong_wind(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(strong_wind(fx.grid(spark, sf).select(*KEYS, "u10", "v10")), 6, "wind_speed", "u10", "v10")


@query
def flt7_next_to_previous(spark: SparkSession, sf: str) -> DataFrame:
    return next_to_previous(previous_cells(fx.grid(spark, sf).select(*KEYS)))


@query
def srt1_raster_order(spark: SparkSession, sf: str) -> DataFrame:
    return readers.raster_order(fx.grid(spark, sf).select(*KEYS, "sp"))


@query
def srt2_report_order(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reports.wind_report(fx.grid(spark, sf)), 6, "wind_speed", "wind_direction")


@query
def srt3_preview(spark: SparkSession, sf: str) -> DataFrame:
    return readers.raster_order(fx.grid(spark, sf).select(*KEYS, "sp", "tcc")).limit(10)


@query
def set1_time_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return longs(star.time_dimension(fx.weather(spark, sf)), "year", "month", "day", "hour")


@query
def set2_location_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return star.location_dimension(fx.weather(spark, sf))


@query
def set3_condition_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return star.condition_dimension(fx.weather(spark, sf)).drop("weather_id")


@query
def set3_conditions_with_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Conditions of a table that has labels for the cloud cover, where it is known; facts point at them."""
    cover = F.when(F.col("tcc") < 0.3, "clear").when(F.col("tcc") < 0.8, "cloudy")
    labelled = fx.weather(spark, sf).withColumn("cloud_cover_category", cover)
    facts = star.fact(labelled).groupBy("weather_id").agg(F.count(F.lit(1)).alias("facts"))
    return star.condition_dimension(labelled).join(facts, "weather_id").drop("weather_id")


@query
def set4_union_of_pieces(spark: SparkSession, sf: str) -> DataFrame:
    g = fx.grid(spark, sf)
    dry = g.where(F.col("tp").isNull()).select(*KEYS, "sp")
    wet = g.where(F.col("tp").isNotNull()).select("sp", "tp", *KEYS)
    return readers.union_pieces([wet, dry]).select(*KEYS, "sp", "tp")
