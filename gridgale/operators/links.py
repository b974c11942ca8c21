"""Which detections of one step can continue which of the step before."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridgale.functions.geo import RADIUS_TRACKS, distance_km

# Fixed value: greatest speed of a storm, km/h.
PROP_SPEED = 80.0
IDX_BITS = 24  # detections of one step are numbered below 2**24


def node_id(step: Column, idx: Column) -> Column:
    """A number that sorts like (step, idx)."""
    return F.call_function("shiftleft", step.cast("long"), F.lit(IDX_BITS)) + idx.cast("long")


def step_of(node: Column) -> Column:
    return F.call_function("shiftright", node, F.lit(IDX_BITS))


def detections(storms: DataFrame, dt: float = 1.0, kind: str = "cyclonic") -> DataFrame:
    """Storms as records (`time`, `step`, `idx`, `node`, position, size, `type`, `n`).

    `step` counts time steps of `dt` hours from the epoch, so steps without detections
    leave a gap. `idx` numbers the detections of a step in the order they were found. Two
    times in one step, or more detections than a node can number, are an error: nodes
    would no longer be unique.
    """
    order = [c for c in ("idx", "label") if c in storms.columns][:1]
    per_step = Window.partitionBy("step")
    seconds = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col("time"))
    step = F.round(seconds / F.lit(3600.0 * dt)).cast("long")
    one_time = F.min("time").over(per_step) == F.max("time").over(per_step)
    numbered = F.row_number().over(per_step.orderBy(*order)) - 1
    idx = (
        F.when(~one_time, F.raise_error(F.lit(f"several times in one step; give a dt below {dt} hours")))
        .when(numbered >= 1 << IDX_BITS, F.raise_error(F.lit("too many detections in one step")))
        .otherwise(numbered)
    )
    found = storms.withColumn("step", step).select(
        "time",
        "step",
        idx.cast("int").alias("idx"),
        F.col("lon").cast("double").alias("lon"),
        F.col("lat").cast("double").alias("lat"),
        F.col("amp_abs").alias("amp"),
        F.col("area_km2").alias("area"),
        F.lit(kind).alias("type"),
        F.count(F.lit(1)).over(per_step).alias("n"),
    )
    return found.withColumn("node", node_id(F.col("step"), F.col("idx")))


def _boxes(reach: float) -> tuple[Column, Column, Column, Column]:
    """The boxes that a detection's reach touches, rows and columns, and the row and column of its own box.

    The sphere is cut into boxes as high as the reach.
    """
    delta = reach / RADIUS_TRACKS + 1e-9
    height = math.degrees(delta)
    boxes = max(1, int(360.0 / height))
    width = 360.0 / boxes

    lat, lon = F.col("lat"), F.col("lon")
    polar = F.abs(F.radians(lat)) + F.lit(delta) >= F.lit(math.pi / 2)
    half = F.when(polar, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(F.lit(1.0), F.lit(math.sin(min(delta, math.pi / 2))) / F.cos(F.radians(lat)))))
    ) + F.lit(1e-9)

    def box(x: Column, size: float) -> Column:
        return F.floor(x / F.lit(size)).cast("long")

    rows_near = F.sequence(box(lat - height, height), box(lat + height, height))
    columns_near = F.array_distinct(
        F.transform(
            F.sequence(box(lon - half, width), box(lon + half, width)),
            lambda b: F.pmod(b, F.lit(boxes).cast("long")),
        )
    )
    return rows_near, columns_near, box(lat, height), F.pmod(box(lon, width), F.lit(boxes).cast("long"))


def candidate_links(found: DataFrame, dt: float = 1.0, prop_speed: float = PROP_SPEED) -> DataFrame:
    """(`u`, `v`, `km`): nodes of consecutive steps, of one type and within reach.

    A detection looks only into the boxes its reach touches, so far pairs of a step never meet. All pairs within
    reach are rows, so in a crowd they grow with its square; `tracks.resolve` does without them.
    """
    reach = prop_speed * dt
    rows_near, columns_near, own_row, own_column = _boxes(reach)
    from_side = (
        found.select(
            (F.col("step") + 1).alias("step"), "type", F.col("node").alias("u"),
            F.col("lon").alias("ulon"), F.col("lat").alias("ulat"), rows_near.alias("_rows"), columns_near.alias("_columns"),
        )
        .withColumn("_by", F.explode("_rows"))
        .withColumn("_bx", F.explode("_columns"))
        .drop("_rows", "_columns")
    )
    to_side = found.select(
        "step", "type", F.col("node").alias("v"), F.col("lon").alias("vlon"), F.col("lat").alias("vlat"),
        own_row.alias("_by"), own_column.alias("_bx"),
    )
    met = from_side.join(to_side, ["step", "type", "_by", "_bx"])
    km = distance_km(F.col("ulon"), F.col("ulat"), F.col("vlon"), F.col("vlat"))
    return met.withColumn("km", km).where(F.col("km") <= F.lit(reach)).select("u", "v", "km")


def steps_in_reach(found: DataFrame, dt: float = 1.0, prop_speed: float = PROP_SPEED) -> DataFrame:
    """(`step`) for the steps that may be led to: a detection lies in a box that the reach of one of the step before touches.

    Boxes meet, not detections: a crowd has few.
    """
    rows_near, columns_near, own_row, own_column = _boxes(prop_speed * dt)
    touched = (
        found.select((F.col("step") + 1).alias("step"), "type", rows_near.alias("_rows"), columns_near.alias("_columns")).distinct()
        .withColumn("_by", F.explode("_rows"))
        .withColumn("_bx", F.explode("_columns"))
        .select("step", "type", "_by", "_bx")
    )
    own = found.select("step", "type", own_row.alias("_by"), own_column.alias("_bx")).distinct()
    return own.join(touched, ["step", "type", "_by", "_bx"], "left_semi").select("step").distinct()


def nearest_next(links: DataFrame) -> DataFrame:
    """For each node, the nearest node within reach in the next step; ties go to the first."""
    best = links.groupBy("u").agg(F.min(F.struct("km", "v")).alias("_b"))
    return best.select("u", "_b.v", "_b.km")
