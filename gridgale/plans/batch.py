"""The batch jobs, each from its source folder to its sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridgale.grid import GridSpec, VIETNAM_GRID
from gridgale.operators import merge, reports, star, storms
from gridgale.operators.regions import DetectParams
from gridgale.plans import storm_table
from gridgale.sources import readers, sinks


def merge_job(
    spark: SparkSession, weather_root: str, rain_root: str, out: str, partitions: int | None = None, by_day: bool = True
) -> None:
    """Join raw rain and weather. Day folders by default; with `partitions` a flat folder."""
    joined = merge.merge_weather(
        readers.read_rain(spark, rain_root), readers.read_weather(spark, weather_root)
    )
    if by_day:
        sinks.write_by_day(joined, out)
    else:
        sinks.write_files(joined, out, partitions)


def store_for_merge(spark: SparkSession, weather_root: str, rain_root: str, weather_table: str, rain_table: str, buckets: int | None = None) -> None:
    """Raw weather and rain as tables in equal buckets of the instant, for merges that need no shuffle.

    Without a number given, there are as many `buckets` as the weather has rows for.

    Coordinates are no bucket keys: joins compare normalised floating point numbers, which have hashes of their own.
    """
    weather = readers.read_weather(spark, weather_root)
    buckets = buckets or sinks.buckets_for(weather)
    sinks.write_bucketed(weather, weather_table, ["time"], buckets)
    sinks.write_bucketed(readers.read_rain(spark, rain_root), rain_table, ["valid_time"], buckets)


def merge_tables_job(spark: SparkSession, weather_table: str, rain_table: str, out: str) -> None:
    """`merge_job` over the tables of `store_for_merge`, bucket by bucket."""
    sinks.write_files(merge.merge_weather(spark.table(rain_table), spark.table(weather_table)), out)


def transform_job(spark: SparkSession, joined_root: str, result_out: str, rain_out: str) -> None:
    """Derived physics by day, and the daily rain report: two outputs of one table."""
    joined = readers.read_with_time_cast(spark, joined_root).drop("year", "month", "day")
    sinks.write_by_day(merge.weather_result(joined), result_out)
    sinks.write_files(reports.daily_precipitation(merge.inside(joined, **merge.BBOX)), rain_out)


def split_job(spark: SparkSession, weather_root: str, out: str) -> None:
    """Write the star schema, one folder per table."""
    for name, table in star.split(readers.read_weather(spark, weather_root)).items():
        sinks.write_files(table, f"{out}/{name}")


def storm_job(
    spark: SparkSession,
    joined_root: str,
    start: str,
    end: str,
    out: str,
    spec: GridSpec = VIETNAM_GRID,
    params: DetectParams = DetectParams(),
    threshold: float = 1.5,
    emit_quiet_hours: bool = False,
    with_masks: bool = True,
) -> None:
    """Detect the storms of a time range, which replace those that the storm folder has for it.

    The folder keeps a version of each month, see `storm_table`. Only the months of the range are read and
    written, and they change all together when the range is done; a run that breaks off changes nothing.
    Ranges may be run again, in parts and in any order. `read_storms` gives the table.
    """
    joined = readers.read_with_time_cast(spark, joined_root)
    rows = readers.between_times(joined, start, end).select("time", "latitude", "longitude", "u10", "v10", "msl")
    found = storms.frame_storms(rows, spec, params, with_masks, emit_quiet_hours)
    storm_table.replace_range(storms.with_mask_texts(found, spec, params, with_masks), out, start, end, threshold)


def publish_storms(
    spark: SparkSession, folder: str, table: str, prefix: str | None = None, fmt: str = "parquet", append: bool = False, **options: str
) -> None:
    """Put the named storms of a folder into a warehouse table, in place of what it holds unless `append`."""
    put = sinks.append_table if append else sinks.replace_table
    put(storm_table.read_storms(spark, folder, prefix), table, fmt, **options)


def landing_job(batch: DataFrame | None, out: str, append: bool = False) -> None:
    sinks.land(batch, out, append=append)
