"""Low- or high-pressure regions of smoothed frames, measured without leaving the JVM."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridgale.functions import geo
from gridgale.grid import GridSpec

FRAME_FACTS = ["frame_iy", "frame_ix", "missing_wind"]


@dataclass(frozen=True)
class DetectParams:
    """What counts as a storm. The defaults are those of the detection job.

    `center` is `frame_min` (lowest cell of the whole frame), `region_min` or
    `center_of_mass`. `d_thresh` at or above 1 is a limit in km; below 1 it is an
    eccentricity from which each region's limit follows. `globe` repeats both edges of a grid beyond the
    other, so that a storm there may be found twice; `seam` joins the first column to the last instead, on a
    grid that goes once around.
    """

    # Default criteria.
    level: float = 100000.0
    npix_min: int = 9
    npix_max: int = 6000
    rel_amp_thresh: float = 100.0
    d_thresh: float = 2500.0
    cyc: str = "cyclonic"
    cut_lon: float = 1.0
    cut_lat: float = 1.0
    globe: bool = False
    globe_degrees: float = 20.0
    seam: bool = False
    require_internal_extremum: bool = False
    center: str = "frame_min"

    @property
    def sign(self) -> float:
        return 1.0 if self.cyc == "cyclonic" else -1.0


def masked_cells(
    cells: DataFrame, spec: GridSpec, value: str, params: DetectParams, wind: str | None = None
) -> DataFrame:
    """Cells beyond the level, each marked `interior` when its four neighbours are too.

    Neighbouring masked cells always share a region, so the erosion of a region is
    that of the mask and needs no labels: after the filter, two windows over the few
    cells left tell which neighbours are there. Each cell also carries the place of
    its frame's minimum and the strongest wind over the frame's missing cells.
    """
    strength = F.col(wind) if wind else F.lit(None).cast("double")
    picked = cells.select("time", "iy", "ix", F.col(value).alias("v"), strength.alias("wind"))
    beyond = F.col("v") < F.lit(params.level) if params.sign > 0 else F.col("v") > F.lit(params.level)
    frame = Window.partitionBy("time")
    place = F.when(F.col("v").isNotNull(), F.struct("v", "iy", "ix"))
    over_missing = F.when(F.col("v").isNull(), F.col("wind"))
    kept = F.col("_in") | F.col("v").isNull()
    marked = picked.withColumn("_in", F.coalesce(beyond, F.lit(False)))
    if params.sign > 0:
        # The minimum of a frame with low cells is one of them, so the others can go first.
        marked = marked.where(kept).withColumn("_low", F.min(place).over(frame))
    else:
        marked = marked.withColumn("_low", F.min(place).over(frame)).where(kept)
    marked = marked.withColumn("missing_wind", F.max(over_missing).over(frame)).where("_in")

    row = Window.partitionBy("time", "iy").orderBy("ix")
    column = Window.partitionBy("time", "ix").orderBy("iy")
    x_in = (F.lag("ix").over(row) == F.col("ix") - 1) & (F.lead("ix").over(row) == F.col("ix") + 1)
    y_in = (F.lag("iy").over(column) == F.col("iy") - 1) & (F.lead("iy").over(column) == F.col("iy") + 1)
    eroded = marked.withColumn("_x", x_in).withColumn("_y", y_in)
    return eroded.select(
        "time",
        spec.raster(F.col("iy"), F.col("ix")).alias("cell"),
        "iy",
        "ix",
        "v",
        "wind",
        F.coalesce(F.col("_x") & F.col("_y"), F.lit(False)).alias("interior"),
        F.col("_low.iy").alias("frame_iy"),
        F.col("_low.ix").alias("frame_ix"),
        "missing_wind",
    )


def measure_regions(cells: DataFrame, spec: GridSpec, params: DetectParams) -> DataFrame:
    """One row per region (`time`, `label`) with its sizes, extremes and positions.

    Rows of the grid are folded first, map-side, then the region's rows: what reaches
    a region is at most one record per grid row. `interior_cells` lists raster
    positions; it costs nothing where it is not used.
    """
    v, sv = F.col("v"), F.lit(params.sign) * F.col("v")
    inside, ring = F.col("interior"), ~F.col("interior")
    facts = FRAME_FACTS
    wide = (spec.nx - 1) * spec.res_lon > 180.0
    ring_columns = [F.sort_array(F.collect_list(F.when(ring, F.col("ix")))).alias("ring_xs")] if wide else []
    by_row = cells.groupBy("time", "label", "iy").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(inside).alias("n_in"),
        F.min(F.when(inside, sv)).alias("in_low"),
        F.min(F.when(ring, sv)).alias("ring_low"),
        F.sum(F.when(ring, v)).alias("ring_sum"),
        F.min(F.when(ring, F.col("ix"))).alias("x0"),
        F.max(F.when(ring, F.col("ix"))).alias("x1"),
        F.max(F.when(inside, F.col("wind"))).alias("in_wind"),
        F.sum(v).alias("mass"),
        F.sum(v * F.col("ix")).alias("mass_x"),
        F.min(F.struct(sv.alias("s"), F.col("ix").alias("ix"))).alias("low"),
        F.collect_list(F.when(inside, F.col("cell"))).alias("in_cells"),
        *ring_columns,
        *[F.first(f).alias(f) for f in facts],
    )
    latitude = spec.latitude(F.col("iy"))
    ring_row = F.when(
        F.col("x0").isNotNull(),
        F.struct(
            F.sin(F.radians(latitude)).alias("sin"),
            F.cos(F.radians(latitude)).alias("cos"),
            spec.longitude(F.col("x0")).alias("lon0"),
            spec.longitude(F.col("x1")).alias("lon1"),
            *([F.transform("ring_xs", spec.longitude).alias("lons")] if wide else []),
        ),
    )
    regions = by_row.groupBy("time", "label").agg(
        F.sum("n").alias("n_cells"),
        F.sum("n_in").alias("n_interior"),
        F.min("in_low").alias("in_low"),
        F.min("ring_low").alias("ring_low"),
        (F.sum("ring_sum") / (F.sum("n") - F.sum("n_in"))).alias("ring_mean"),
        F.max("in_wind").alias("in_wind"),
        (F.sum(F.col("mass") * F.col("iy")) / F.sum("mass")).alias("mass_iy"),
        (F.sum("mass_x") / F.sum("mass")).alias("mass_ix"),
        F.try_divide(F.sum(F.col("n_in") * latitude), F.sum("n_in")).alias("interior_lat"),
        F.min(F.struct(F.col("low.s").alias("s"), F.col("iy").alias("iy"), F.col("low.ix").alias("ix"))).alias("low"),
        F.collect_list(ring_row).alias("_ring"),
        F.array_sort(F.flatten(F.collect_list("in_cells"))).alias("interior_cells"),
        *[F.first(f).alias(f) for f in facts],
    )
    sign = F.lit(params.sign)
    return regions.select(
        "time",
        "label",
        "n_cells",
        "n_interior",
        (sign * F.col("in_low")).alias("amp_abs"),
        (sign * F.col("ring_low")).alias("ring_extremum"),
        "ring_mean",
        (sign * F.col("ring_mean") - F.col("in_low")).alias("amp_rel"),
        (F.col("in_low") < F.col("ring_low")).alias("internal_extremum"),
        # A region without interior is no candidate; its extent is not worth the work.
        F.when(F.col("n_interior") > 0, ring_extent_km("_ring", wide)).alias("extent_km"),
        F.col("in_wind").alias("interior_wind"),
        spec.latitude(F.col("mass_iy")).alias("mass_lat"),
        spec.longitude(F.col("mass_ix")).alias("mass_lon"),
        spec.latitude(F.col("low.iy")).alias("low_lat"),
        spec.longitude(F.col("low.ix")).alias("low_lon"),
        "interior_lat",
        "interior_cells",
        *facts,
    )


def ring_extent_km(ring: str, wide: bool = False) -> Column:
    """Greatest distance between two ring cells, from the ends of each grid row.

    On two parallels the distance grows with the difference in longitude up to 180
    degrees, so the farthest pair always lies at row ends: two points per grid row
    stand for the whole ring, and no pairs become rows. Only on a grid that spans more
    than 180 degrees all ring cells of the two rows have to be compared.
    """

    def cosine(difference: Column, a: Column, b: Column) -> Column:
        return a["sin"] * b["sin"] + F.cos(F.radians(difference)) * a["cos"] * b["cos"]

    def rows_apart(a: Column, b: Column) -> Column:
        if not wide:
            return cosine(F.greatest(a["lon1"] - b["lon0"], b["lon1"] - a["lon0"]), a, b)
        return F.array_min(
            F.transform(
                a["lons"],
                lambda x: F.array_min(F.transform(b["lons"], lambda y: cosine(x - y, a, b))),
            )
        )

    least = F.array_min(
        F.transform(ring, lambda a: F.array_min(F.transform(ring, lambda b: rows_apart(a, b))))
    )
    return geo.angle_to_km(least, geo.RADIUS_EXTENT)


def accept(regions: DataFrame, spec: GridSpec, params: DetectParams) -> DataFrame:
    """Regions that pass all tests."""
    if params.d_thresh < 1:
        area = geo.region_area_km2(F.col("n_cells"), F.col("interior_lat"), spec.res_lat, spec.res_lon)
        limit = geo.major_axis_from_eccentricity(area, F.lit(params.d_thresh)) * F.lit(2.0)
    else:
        limit = F.lit(params.d_thresh)
    passed = (
        (F.col("n_interior") > 0)
        & F.col("n_cells").between(params.npix_min, params.npix_max)
        & (F.col("amp_rel") >= F.lit(params.rel_amp_thresh))
        & (F.col("extent_km") < limit)
    )
    if params.require_internal_extremum:
        passed = passed & F.col("internal_extremum")
    return regions.where(passed)


def place(regions: DataFrame, spec: GridSpec, params: DetectParams) -> DataFrame:
    """Add centre, area and strongest wind."""
    centers = {
        "frame_min": (spec.latitude(F.col("frame_iy")), spec.longitude(F.col("frame_ix"))),
        "region_min": (F.col("low_lat"), F.col("low_lon")),
        "center_of_mass": (F.col("mass_lat"), F.col("mass_lon")),
    }
    lat, lon = centers[params.center]
    placed = regions.withColumns({"lat": lat, "lon": lon})
    area = geo.region_area_km2(F.col("n_cells"), F.col("lat"), spec.res_lat, spec.res_lon)
    wind = F.greatest(F.lit(0.0), F.col("interior_wind"), F.col("missing_wind"))
    return placed.withColumns({"area_km2": area, "max_wind": wind})
