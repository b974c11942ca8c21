"""The storm table as a folder with a version of each month.

Rows carry the number of their storm within the month. The month's record carries what the naming of other months
depends on: the first and the last centre, and how many storms it has. Reading adds these up over the
months, one row each, so ids are those of one run over all hours, however the table came about, and a
month that is run again leaves the files of the others alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridgale.functions.geo import planar_distance
from gridgale.functions.keys import storm_name
from gridgale.operators.storms import HOUR_FIELDS
from gridgale.operators.windows import numbers_by_year, storm_starts
from gridgale.session import cut_lineage
from gridgale.sources import readers, versions

PART = ["month"]


def _month(column: str):
    return F.date_format(column, "yyyy-MM")


def replace_range(hours: DataFrame, path: str, start: str, end: str, threshold: float) -> None:
    """Put unnamed storm hours in place of those the table has between `start` and `end`, both included."""
    spark = hours.sparkSession
    fields = ["time", *HOUR_FIELDS]
    new = hours.select(*fields)
    months = spark.range(1).select(
        F.explode(F.sequence(F.trunc(F.lit(start).cast("date"), "month"), F.lit(end).cast("date"), F.expr("INTERVAL 1 MONTH"))).alias("_m")
    ).select(_month("_m").alias("month"))
    known = versions.current(spark, path, PART)
    old = None if known is None else versions.rows_of(spark, path, known.join(months, PART, "left_semi"), PART)
    if old is not None:
        inside = F.col("time").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
        new = new.unionByName(old.where(~inside).select(*fields))
    whole = cut_lineage(new.withColumn("month", _month("time")))
    storms, quiet = whole.where(F.col("lon_storm").isNotNull()), whole.where(F.col("lon_storm").isNull())
    in_month = Window.partitionBy("month").orderBy("time")
    begun = storm_starts(storms, threshold).withColumn("_starts", F.when(F.row_number().over(in_month) == 1, 1).otherwise(F.col("_starts")))
    numbered = begun.withColumn("number", F.sum("_starts").over(in_month).cast("long")).select("month", *fields, "number", "_starts")
    numbered = cut_lineage(
        numbered.unionByName(quiet.select("month", *fields, F.lit(None).cast("long").alias("number"), F.lit(0).alias("_starts")))
    )
    version = versions.add_rows(numbered, path, PART)
    centre = F.when(F.col("number").isNotNull(), F.struct("lon_storm", "lat_storm"))
    at = F.when(F.col("number").isNotNull(), F.col("time"))
    facts = numbered.groupBy("month").agg(
        F.min_by(centre, at).alias("first"), F.max_by(centre, at).alias("last"), F.max("number").alias("storms"),
    )
    versions.record(months.join(facts, PART, "left").withColumn("threshold", F.lit(float(threshold))), path, version)


def _offsets(records: DataFrame) -> DataFrame:
    """(`month`, `before`, `goes_on`): the storms of earlier months, and whether the first goes on from the month
    before. The window has one row a month."""
    order = Window.orderBy("month")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    with_storms = records.where(F.col("storms") > 0).withColumn("_last", F.lag("last").over(order))
    step = planar_distance(F.col("first.lon_storm"), F.col("first.lat_storm"), F.col("_last.lon_storm"), F.col("_last.lat_storm"))
    linked = with_storms.withColumn("goes_on", F.coalesce((step < F.col("threshold")).cast("long"), F.lit(0)))
    return linked.withColumn("before", F.coalesce(F.sum(F.col("storms") - F.col("goes_on")).over(earlier), F.lit(0)) - F.col("goes_on")).select(
        "month", "before", "goes_on"
    )


def read_storms(spark: SparkSession, path: str, prefix: str | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """The storm table with ids; of the hours from `start` to `end` where given, whose months alone are read.

    Ids are the year in which a storm began and its number there, or `prefix` and its number in all.
    """
    records = versions.current(spark, path, PART)
    if records is None:
        raise FileNotFoundError(f"no storms have been written to {path}")
    wanted = records
    if start is not None and prefix:  # numbers by year also need the months in which storms began
        wanted = wanted.where(F.col("month") >= F.lit(start[:7]))
    if end is not None:
        wanted = wanted.where(F.col("month") <= F.lit(end[:7]))
    rows = versions.rows_of(spark, path, wanted, PART)
    if rows is None:
        raise FileNotFoundError(f"no month of {path} has rows")
    placed = rows.join(_offsets(records), PART, "left")
    first = (F.col("number") == 1) & (F.col("_starts") == 1) & (F.col("goes_on") == 1)
    numbered = placed.withColumns({
        "_number": F.col("number") + F.col("before"), "_starts": F.when(first, 0).otherwise(F.col("_starts")),
    })
    storms = numbered.where(F.col("number").isNotNull())
    if prefix:
        named = storms.withColumn("id", storm_name(prefix, F.col("_number")))
    else:
        named = numbers_by_year(storms).withColumn("id", storm_name(F.col("_year").cast("string"), F.col("_of_year")))
    year = F.lit(prefix) if prefix else F.date_format("time", "yyyy")
    quiet = numbered.where(F.col("number").isNull()).withColumn("id", F.concat(year, F.lit("-00")))
    out = named.select("time", "id", *HOUR_FIELDS).unionByName(quiet.select("time", "id", *HOUR_FIELDS))
    if start is not None or end is not None:
        out = readers.between_times(out, start or "0001-01-01 00:00:00", end or "9999-12-31 23:59:59")
    return out
