"""Window functions over a whole ordered table, without a single-task window.

A window without PARTITION BY puts every row in one task. Here rows are windowed
inside buckets that follow the order (say month, then time), and only one row per
bucket goes on to link a bucket with the one before it. The last, unpartitioned
step sees one row per coarsest bucket, that is one per calendar month.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridgale.functions.geo import planar_distance
from gridgale.functions.keys import storm_name
from gridgale.functions.physics import wind_speed

MONTH = "_month"


@dataclass(frozen=True)
class Lag:
    """`out` = the value of column `value` in the row before, by `order`."""

    out: str
    value: str
    order: tuple[str, ...]


def with_month(df: DataFrame, time_column: str = "time") -> DataFrame:
    number = F.year(time_column) * 12 + F.month(time_column)
    return df.withColumn(MONTH, number)


def ordered_lags(df: DataFrame, lags: Sequence[Lag], levels: Sequence[Sequence[str]]) -> DataFrame:
    """Global lags; `levels` lists bucket keys from coarse to fine.

    Each level's keys must be a monotone prefix of every lag's order, and orders must
    be total.
    """
    if not levels:
        whole = Window.partitionBy()
        return df.withColumns({g.out: F.lag(g.value).over(whole.orderBy(*g.order)) for g in lags})
    keys = list(levels[-1])
    inner = Window.partitionBy(*keys)
    inside = df.withColumns({g.out: F.lag(g.value).over(inner.orderBy(*g.order)) for g in lags})
    inside = inside.withColumns(
        {f"_first_{g.out}": F.row_number().over(inner.orderBy(*g.order)) == 1 for g in lags}
    )
    lasts = df.groupBy(*keys).agg(
        *[F.max_by(g.value, F.struct(*g.order)).alias(f"_last_{g.out}") for g in lags]
    )
    between = [Lag(f"_carry_{g.out}", f"_last_{g.out}", tuple(keys)) for g in lags]
    carries = ordered_lags(lasts, between, levels[:-1]).select(*keys, *[c.out for c in between])
    linked = inside.join(carries, keys, "left").withColumns(
        {g.out: F.when(F.col(f"_first_{g.out}"), F.col(f"_carry_{g.out}")).otherwise(F.col(g.out)) for g in lags}
    )
    return linked.select(*df.columns, *[g.out for g in lags])


def running_total(df: DataFrame, value: str, out: str, order: Sequence[str], bucket: str = MONTH) -> DataFrame:
    """Sum of `value` from the first row up to this one, by `order`."""
    inside = df.withColumn(
        out, F.sum(value).over(Window.partitionBy(bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    )
    earlier = (
        df.groupBy(bucket)
        .agg(F.sum(value).alias("_total"))
        .withColumn("_before", F.sum("_total").over(Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)))
        .select(bucket, F.coalesce("_before", F.lit(0)).alias("_before"))
    )
    return inside.join(earlier, bucket).withColumn(out, F.col(out) + F.col("_before")).drop("_before")


def strong_wind(df: DataFrame, above: float = 10.0) -> DataFrame:
    return df.withColumn("wind_speed", wind_speed(F.col("u10"), F.col("v10"))).where(F.col("wind_speed") > above)


def previous_cells(df: DataFrame) -> DataFrame:
    """Latitude of the cell before in (time, longitude, latitude) order, and longitude of the
    cell before in (time, latitude, longitude) order. (time, latitude, longitude) is unique."""
    lags = [
        Lag("prev_latitude", "latitude", ("time", "longitude", "latitude")),
        Lag("prev_longitude", "longitude", ("time", "latitude", "longitude")),
    ]
    return ordered_lags(with_month(df), lags, [[MONTH], [MONTH, "time"]]).drop(MONTH)


def previous_cells_one_task(df: DataFrame) -> DataFrame:
    """The same by two plain global windows: the definition, for checks on small tables."""
    whole = Window.partitionBy()
    return df.withColumns(
        {
            "prev_latitude": F.lag("latitude").over(whole.orderBy("time", "longitude", "latitude")),
            "prev_longitude": F.lag("longitude").over(whole.orderBy("time", "latitude", "longitude")),
        }
    )


def next_to_previous(df: DataFrame, res: float = 0.25) -> DataFrame:
    """Rows that continue the cell before by one grid step; the first row has none and drops out."""
    return df.where(
        (F.col("longitude") == F.col("prev_longitude") + F.lit(res))
        | (F.col("latitude") == F.col("prev_latitude") + F.lit(res))
    )


def strong_wind_regions(df: DataFrame, above: float = 10.0, res: float = 0.25) -> DataFrame:
    """Strong-wind cells that touch the strong-wind cell before them."""
    windy = strong_wind(df.select("time", "latitude", "longitude", "u10", "v10"), above)
    linked = next_to_previous(previous_cells(windy), res)
    return linked.select("time", "latitude", "longitude", "wind_speed")


def storm_starts(hours: DataFrame, threshold: float = 1.5) -> DataFrame:
    """`hours` with `_starts`, 1 where a storm begins: the storm goes on while its centre moves less than
    `threshold` degrees from the last hour that had a storm. Quiet hours do not interrupt."""
    moved = ordered_lags(
        with_month(hours), [Lag("_lon", "lon_storm", ("time",)), Lag("_lat", "lat_storm", ("time",))], [[MONTH]]
    )
    step = planar_distance(F.col("lon_storm"), F.col("lat_storm"), F.col("_lon"), F.col("_lat"))
    return moved.withColumn("_starts", F.when(step < F.lit(threshold), 0).otherwise(1)).drop("_lon", "_lat")


def numbers_by_year(numbered: DataFrame) -> DataFrame:
    """`_year` and `_of_year`, the year a storm began in and its number there, for hours with the number of
    their storm in all (`_number`, with `_starts` at its first hour). One row for each storm is joined back."""
    begun = numbered.where(F.col("_starts") == 1).select("_number", F.year("time").alias("_year"))
    firsts = begun.groupBy("_year").agg(F.min("_number").alias("_first"))
    of_storm = begun.join(firsts, "_year").select("_number", "_year", (F.col("_number") - F.col("_first") + 1).alias("_of_year"))
    return numbered.join(of_storm, "_number")


def name_storms(hours: DataFrame, threshold: float = 1.5, prefix: str | None = None) -> DataFrame:
    """Give each storm hour an `id`: the year in which its storm began and the storm's number in that year, or,
    with a `prefix`, that and the storm's number in all.

    `hours` has one row per time with `lon_storm` and `lat_storm`.
    """
    numbered = running_total(storm_starts(hours, threshold), "_starts", "_number", ["time"])
    if prefix:
        return numbered.withColumn("id", storm_name(F.lit(prefix), F.col("_number"))).select("id", *hours.columns)
    by_year = numbers_by_year(numbered)
    return by_year.withColumn("id", storm_name(F.col("_year").cast("string"), F.col("_of_year"))).select("id", *hours.columns)


def daily_segments(hourly: DataFrame) -> DataFrame:
    """Lines from each hour's storm centre to the next hour's, within one day.

    `hourly` keeps quiet hours as rows with null centres; they break the line.
    """
    day = Window.partitionBy(F.to_date("time")).orderBy("time")
    both = hourly.select(
        "time",
        F.lag("lon_storm").over(day).alias("from_lon"),
        F.lag("lat_storm").over(day).alias("from_lat"),
        F.col("lon_storm").alias("to_lon"),
        F.col("lat_storm").alias("to_lat"),
    )
    return both.dropna(subset=["from_lon", "from_lat", "to_lon", "to_lat"])
