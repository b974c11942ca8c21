"""Batch readers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from gridgale.schema import RAW_RAIN, RAW_WEATHER
from gridgale.sources import versions


def _read(spark: SparkSession, paths: str | Sequence[str], schema: StructType | None, base: str | None):
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if base is not None:
        reader = reader.option("basePath", base)
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def read_weather(spark: SparkSession, paths: str | Sequence[str], base: str | None = None) -> DataFrame:
    """Raw observations; `base` is the table root when `paths` are parts or globs of it."""
    return _read(spark, paths, RAW_WEATHER, base)


def read_rain(spark: SparkSession, paths: str | Sequence[str], base: str | None = None) -> DataFrame:
    return _read(spark, paths, RAW_RAIN, base)


def read_table_files(spark: SparkSession, root: str) -> DataFrame:
    """A derived table: schema from the files, partition columns from the folders."""
    return _read(spark, root, None, None)


def read_with_time_cast(spark: SparkSession, root: str, column: str = "time") -> DataFrame:
    """A derived table whose times may be held as text; they come back as instants."""
    df = read_table_files(spark, root)
    if dict(df.dtypes)[column] == "string":
        df = df.withColumn(column, F.col(column).cast("timestamp_ntz"))
    return df


def only_year(df: DataFrame, year: int) -> DataFrame:
    """One yearly partition; the predicate names the partition column, so others are not listed."""
    return df.where(F.col("year") == year)


def _instant(value: str | datetime) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def between_times(
    df: DataFrame, start: str | datetime, end: str | datetime, column: str = "time"
) -> DataFrame:
    """Rows of the closed time range.

    On a table partitioned by year, month and day the range is repeated on those
    columns, so only the folders it touches are read.
    """
    df = df.where((F.col(column) >= _instant(start)) & (F.col(column) <= _instant(end)))
    if {"year", "month", "day"} <= set(df.columns):
        low, high = (datetime.fromisoformat(str(x)).date() for x in (start, end))
        df = df.where(_partitions_between(low, high))
    return df


def _partitions_between(low: date, high: date) -> Column:
    number = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    by_day = number.between(low.year * 10000 + low.month * 100 + low.day,
                            high.year * 10000 + high.month * 100 + high.day)
    return F.col("year").between(low.year, high.year) & by_day


def scan_table(
    spark: SparkSession,
    table: str,
    columns: Sequence[str],
    start: str,
    end: str,
    time_column: str = "time",
) -> DataFrame:
    """All wanted columns of one time range of a catalog table, in a single scan."""
    keys = [time_column, "latitude", "longitude"]
    wanted = keys + [c for c in columns if c not in keys]
    return between_times(spark.table(table), start, end, time_column).select(*wanted)


def raster_order(df: DataFrame, time_column: str = "time") -> DataFrame:
    """Frames in time order, each from its north-west cell row by row."""
    return df.orderBy(F.asc(time_column), F.desc("latitude"), F.asc("longitude"))


def union_pieces(pieces: Sequence[DataFrame]) -> DataFrame:
    """Daily pieces put together by column name; a column a piece lacks is null there."""
    first, *rest = pieces
    for piece in rest:
        first = first.unionByName(piece, allowMissingColumns=True)
    return first


def read_landed_days(spark: SparkSession, root: str, days: DataFrame, schema: StructType) -> DataFrame:
    """The landed rows of the days in a table (`day`), whose folders are picked while the query runs."""
    # Folders are only picked by tables that a comparison may have made smaller.
    wanted = days.where(F.col("day") >= F.lit("0001-01-01").cast("date")).select(*[part("day").alias(name) for name, part in (("year", F.year), ("month", F.month), ("day", F.dayofmonth))]).distinct()
    parts = [StructField(name, IntegerType()) for name in wanted.columns]
    return spark.read.schema(StructType([*schema.fields, *parts])).parquet(root).join(wanted, wanted.columns, "left_semi")


def read_landed(spark: SparkSession, path: str, days: DataFrame | None = None) -> DataFrame:
    """What `sinks.land_versions` has landed; only the days in a table (`day`) where given."""
    parts = ["year", "month", "day"]
    known = versions.current(spark, path, parts)
    if known is None:
        raise FileNotFoundError(f"nothing has been landed in {path}")
    if days is not None:
        wanted = days.select(F.year("day").alias("year"), F.month("day").alias("month"), F.dayofmonth("day").alias("day")).distinct()
        known = known.join(wanted, parts, "left_semi")
    return versions.rows_of(spark, path, known, parts)
