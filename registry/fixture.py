"""Observations on a 20 x 15 grid, derived from the keys of the orders table.

Every order key becomes one cell; 300 keys make a frame. The number of frames grows
with the table. The same text runs in Spark and in DuckDB but for the time arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridgale.functions.times import from_epoch_ns, to_epoch_ns
from gridgale.grid import GridSpec
from gridgale.operators.links import detections
from gridgale.operators.merge import dashboard_table, merge_weather

SPEC = GridSpec(ny=20, nx=15, north=24.0, west=102.0)

SPARK_TIME = "timestampadd(HOUR, CAST(frame * {step} AS INT), TIMESTAMP_NTZ '2024-01-01 00:00:00')"
DUCK_TIME = "TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(frame * {step} AS INTEGER))"

GRID_SQL = """
SELECT frame, iy, ix, {time} AS time,
 24.0E0 - 0.25E0*iy AS latitude, 102.0E0 + 0.25E0*ix AS longitude,
 ((k*7919) % 4001)/100.0E0 - 20.0E0 AS u10, ((k*104729) % 4001)/100.0E0 - 20.0E0 AS v10,
 288.15E0 + ((k*31) % 2000)/100.0E0 AS t2m,
 288.15E0 + ((k*31) % 2000)/100.0E0 - ((k*17) % 1000)/100.0E0 AS d2m,
 CASE WHEN k % 11 = 0 THEN NULL ELSE ((k*13) % 500)/100000.0E0 END AS tp,
 100000.0E0 + (k*7) % 1500 AS sp,
 CASE WHEN ix < 5 THEN NULL ELSE 298.15E0 + (k % 400)/100.0E0 END AS sst,
 (k % 101)/100.0E0 AS tcc,
 101300.0E0 - (CASE WHEN frame % 6 = 5 THEN 400.0E0 ELSE 2500.0E0 END)
   * exp(-((ix-(4+frame%8))*(ix-(4+frame%8)) + (iy-(5+frame%3))*(iy-(5+frame%3)))/18.0E0)
   - (CASE WHEN frame % 4 = 3 THEN 2200.0E0 ELSE 0.0E0 END)
   * exp(-((ix-7)*(ix-7) + (iy-16)*(iy-16))/10.0E0) AS msl
FROM (SELECT k, frame, CAST(floor(cell/15) AS BIGINT) AS iy, cell % 15 AS ix FROM
  (SELECT o_orderkey AS k, CAST(floor(o_orderkey/300) AS BIGINT) AS frame,
          o_orderkey % 300 AS cell FROM {orders}) a) b
"""


def grid(spark: SparkSession, sf_dir: str, hours_per_frame: int = 1) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    text = GRID_SQL.format(time=SPARK_TIME.format(step=hours_per_frame), orders="{orders}")
    return spark.sql(text, orders=orders)


def climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames 18 hours apart, so that the table spans months and years."""
    return grid(spark, sf_dir, hours_per_frame=18)


def crowd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections of a whole year in a square of 1.5 degrees: an order each, dealt over the hours."""
    key = F.col("o_orderkey")
    hours = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.timestamp_add("HOUR", (key % 8760).cast("int"), F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")).alias("time"),
        key.alias("label"), (F.lit(105.0) + (key * 7919) % 1500 / 1000.0).alias("lon"),
        (F.lit(15.0) + (key * 104729) % 1500 / 1000.0).alias("lat"), F.lit(1.0).alias("amp_abs"), F.lit(1.0).alias("area_km2"),
    )
    return detections(hours)


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw weather form: epoch nanoseconds, all 17 columns, measures as doubles."""
    g = grid(spark, sf_dir)
    nanos = to_epoch_ns(F.col("time"))
    zero = F.lit(0).cast("long")
    return g.select(
        nanos.alias("time"), "latitude", "longitude", zero.alias("number"), zero.alias("step"),
        F.lit(0.0).alias("surface"), nanos.alias("valid_time"), "u10", "v10", "d2m", "t2m", "msl",
        "sst", "sp", "tcc", F.lit(0.0).alias("tciw"), F.lit(0.0).alias("tclw"),
    )


def rain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rain form; issued one hour before it is valid."""
    g = grid(spark, sf_dir)
    nanos = to_epoch_ns(F.col("time"))
    hour = F.lit(3_600_000_000_000).cast("long")
    zero = F.lit(0).cast("long")
    return g.select(
        (nanos - hour).alias("time"), "latitude", "longitude", zero.alias("number"),
        zero.alias("step"), F.lit(0.0).alias("surface"), nanos.alias("valid_time"), "tp",
    )


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_weather(rain(spark, sf_dir), weather(spark, sf_dir))


def dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard_table(joined(spark, sf_dir))


def climate_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving table over the long span."""
    c = climate(spark, sf_dir).where(F.col("tp").isNotNull())
    celsius = c.withColumns({n: F.col(n) - F.lit(273.15) for n in ("t2m", "d2m")})
    return dashboard_table(celsius)


def terrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One elevation per cell."""
    cells = grid(spark, sf_dir).select("iy", "ix", "latitude", "longitude").distinct()
    elevation = ((F.col("iy") * 97 + F.col("ix") * 53) % 1500).cast("double")
    return cells.select("latitude", "longitude", elevation.alias("elevation"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations as a producer sees them: instants instead of nanoseconds."""
    w = weather(spark, sf_dir)
    return w.withColumns(
        {n: from_epoch_ns(F.col(n)) for n in ("time", "valid_time")} | {"step": F.lit("0 days 00:00:00")}
    )
