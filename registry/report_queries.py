"""Joins, aggregations and windows."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridgale.operators import frames, links, merge, reports, regions, star, storms, terrain, tracks, windows
from gridgale.plans import dashboard
from gridgale.session import cut_lineage, shared_path
from gridgale.sources import readers, sinks
from registry import fixture as fx
from registry.catalog import longs, query, rounded

POINT = (22.0, 104.0)
KEYS = ["time", "latitude", "longitude"]


def storm_hours(df: DataFrame, threshold: float = 1.5, **options) -> DataFrame:
    return storms.hourly_storms(df, fx.SPEC, threshold=threshold, with_masks=False, **{"prefix": "2022"} | options)


def found_lows(spark: SparkSession, sf: str) -> DataFrame:
    """All storms of all frames, each at its own minimum, as track detections."""
    params = regions.DetectParams(center="region_min")
    return links.detections(storms.detect(fx.grid(spark, sf), fx.SPEC, params))


def written_star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    root, tables = shared_path(spark, "star"), {}
    for name, table in star.split(fx.weather(spark, sf)).items():
        sinks.write_files(table, f"{root}/{name}")
        tables[name] = readers.read_table_files(spark, f"{root}/{name}")
    return tables


@query
def joi1_rain_and_weather(spark: SparkSession, sf: str) -> DataFrame:
    joined = merge.merge_weather(fx.rain(spark, sf), fx.weather(spark, sf))
    return rounded(joined.select(*KEYS, "t2m", "d2m", "u10", "v10", "sst", "tcc", "tp"), 6, "t2m", "d2m", "u10", "v10")


def bucketed_join(spark: SparkSession, sf: str) -> DataFrame:
    """Raw tables stored in equal buckets of the instant, and merged."""
    names = {n: f"{n}_{uuid.uuid4().hex}" for n in ("weather", "rain")}
    tables = {"weather": fx.weather(spark, sf), "rain": fx.rain(spark, sf)}
    buckets = sinks.buckets_for(tables["weather"], 8)
    for name, instant in (("weather", "time"), ("rain", "valid_time")):
        sinks.write_bucketed(tables[name], names[name], [instant], buckets, path=shared_path(spark, names[name]))
    return merge.merge_weather(spark.table(names["rain"]), spark.table(names["weather"]))


@query
def joi1_stored_alike(spark: SparkSession, sf: str) -> DataFrame:
    """The same join over tables in equal buckets, which are not shuffled."""
    joined = bucketed_join(spark, sf)
    return rounded(joined.select(*KEYS, "t2m", "d2m", "u10", "v10", "sst", "tcc", "tp"), 6, "t2m", "d2m", "u10", "v10")


@query
def joi2_star_read_back(spark: SparkSession, sf: str) -> DataFrame:
    """The four tables are written, read and joined again."""
    back = star.read_back(written_star(spark, sf)).drop("fact_id", "weather_id")
    return longs(rounded(back, 4, *star.FACT_NAMES.values()), "year", "month", "day", "hour")


@query
def joi3_drop_over_high_ground(spark: SparkSession, sf: str) -> DataFrame:
    found = found_lows(spark, sf)
    kept = terrain.drop_over_high_ground(found, fx.terrain(spark, sf), above=1000.0)
    return longs(kept.select("time", "lon", "lat", "n"), "n")


@query
def joi4_nearest_next(spark: SparkSession, sf: str) -> DataFrame:
    found = cut_lineage(found_lows(spark, sf))
    best = links.nearest_next(links.candidate_links(found))
    at = found.select(F.col("node").alias("u"), "time", F.col("idx").cast("long").alias("idx"))
    to = found.select(F.col("node").alias("v"), F.col("idx").cast("long").alias("next_idx"))
    return rounded(best.join(at, "u").join(to, "v").select("time", "idx", "next_idx", "km"), 3, "km")


@query
def joi5_all_months(spark: SparkSession, sf: str) -> DataFrame:
    climate = fx.climate(spark, sf)
    years = climate.select(F.year("time").alias("year")).distinct()
    return reports.all_months(reports.storms_by_month(storm_hours(climate)), years)


@query
def joi6_region_diameters(spark: SparkSession, sf: str) -> DataFrame:
    params = regions.DetectParams()
    cells, spec = storms.region_cells(fx.grid(spark, sf), fx.SPEC, params)
    measured = regions.measure_regions(cells, spec, params)
    return longs(rounded(measured.select("time", "label", "extent_km"), 4, "extent_km"), "label")


@query
def agg1_daily_precipitation(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reports.daily_precipitation(fx.grid(spark, sf)), 6, "total_precipitation")


@query
def agg1_daily_precipitation_in_area(spark: SparkSession, sf: str) -> DataFrame:
    inside = merge.inside(fx.joined(spark, sf), **merge.BBOX)
    return rounded(reports.daily_precipitation(inside), 6, "total_precipitation")


@query
def agg2_monthly_mean_temperature(spark: SparkSession, sf: str) -> DataFrame:
    monthly = reports.monthly_mean_temperature(fx.climate(spark, sf))
    return longs(rounded(monthly, 6, "avg_temperature"), "year", "month")


@query
def agg3_point_daily(spark: SparkSession, sf: str) -> DataFrame:
    daily = reports.point_daily(fx.climate_dashboard(spark, sf), *POINT, 2024, 1)
    return rounded(daily, 6, "max_temperature", "min_temperature", "total_precipitation")


@query
def agg4_point_monthly(spark: SparkSession, sf: str) -> DataFrame:
    monthly = reports.point_monthly(fx.climate_dashboard(spark, sf), *POINT, 2024)
    return rounded(monthly, 6, "max_temperature", "min_temperature", "max_daily_difference", "rain")


@query
def agg5_storms_by_month(spark: SparkSession, sf: str) -> DataFrame:
    hours = storm_hours(fx.climate(spark, sf), emit_quiet_hours=True)
    return reports.storms_by_month(hours)


@query
def agg5_raw(spark: SparkSession, sf: str) -> DataFrame:
    hours = storm_hours(fx.climate(spark, sf), emit_quiet_hours=True)
    return reports.storms_by_month(hours, exclude_placeholder=False)


@query
def agg6_share_of_rain_by_month(spark: SparkSession, sf: str) -> DataFrame:
    page = dashboard.year_page(fx.climate_dashboard(spark, sf), *POINT, 2024)
    return rounded(page.select("month", "rain", "share"), 6, "rain", "share")


@query
def agg6_share_of_rain_by_day(spark: SparkSession, sf: str) -> DataFrame:
    page = dashboard.month_page(fx.climate_dashboard(spark, sf), *POINT, 2024, 1)
    return rounded(page.select("day", "total_precipitation", "share"), 6, "total_precipitation", "share")


@query
def agg7_value_ticks(spark: SparkSession, sf: str) -> DataFrame:
    ticks = reports.value_ticks(fx.grid(spark, sf), "msl")
    spread = ticks.select("low", "high", F.posexplode("ticks").alias("i", "tick"))
    return longs(rounded(spread, 4, "low", "high"), "i")


@query
def agg8_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.row_counts(
        {
            "weather": fx.weather(spark, sf),
            "rain": fx.rain(spark, sf),
            "known_rain": merge.known_rain(fx.rain(spark, sf)),
        }
    )


@query
def agg9_frame_means(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reports.frame_means(fx.grid(spark, sf), "sst"), 6, "mean")


def id_tracks(spark: SparkSession, sf: str) -> DataFrame:
    """Storm ids taken as tracks, their hours as points."""
    hours = cut_lineage(storm_hours(fx.grid(spark, sf)))
    order = windows.Window.partitionBy("id").orderBy("time")
    return hours.select(
        F.col("id").alias("track_id"), F.row_number().over(order).alias("seq"), "time",
        F.col("lon_storm").alias("lon"), F.col("lat_storm").alias("lat"),
    )


@query
def agg10_track_lengths(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(tracks.track_summary(id_tracks(spark, sf)), 3, "length_km", "straight_km")


@query
def win1_strong_wind_regions(spark: SparkSession, sf: str) -> DataFrame:
    found = windows.strong_wind_regions(fx.grid(spark, sf))
    return rounded(found.orderBy(*KEYS), 6, "wind_speed")


@query
def win2_storm_names(spark: SparkSession, sf: str) -> DataFrame:
    return storm_hours(fx.grid(spark, sf)).select("time", "id", "lon_storm", "lat_storm")


@query
def win2_storm_names_close(spark: SparkSession, sf: str) -> DataFrame:
    return storm_hours(fx.grid(spark, sf), threshold=0.5).select("time", "id", "lon_storm", "lat_storm")


@query
def win3_first_region(spark: SparkSession, sf: str) -> DataFrame:
    first = storms.first_per_frame(storms.detect(fx.grid(spark, sf), fx.SPEC))
    return longs(first.select("time", "label", "n_cells"), "label")


@query
def win4_frame_ordinal(spark: SparkSession, sf: str) -> DataFrame:
    """Frames carry their own time; the ordinal is derived from it, gaps included."""
    hours = fx.climate(spark, sf).select("time").distinct()
    start = hours.agg(F.min("time")).scalar()
    return hours.select("time", F.timestamp_diff("HOUR", start, F.col("time")).alias("ordinal"))


@query
def win5_daily_segments(spark: SparkSession, sf: str) -> DataFrame:
    return windows.daily_segments(storm_hours(fx.grid(spark, sf), emit_quiet_hours=True))


@query
def src6_day_frames(spark: SparkSession, sf: str) -> DataFrame:
    day = dashboard.day_frames(fx.dashboard(spark, sf), date(2024, 1, 2))
    return rounded(
        day, 4, "temperature_celsius", "relative_humidity", "mean_sea_level_pressure", "wind_speed",
        "sea_surface_temperature_celsius",
    )


@query
def grd1_completeness(spark: SparkSession, sf: str) -> DataFrame:
    return frames.completeness(fx.grid(spark, sf), fx.SPEC)
