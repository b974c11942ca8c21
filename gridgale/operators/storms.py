"""Storm detection from cells to hourly storm rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridgale.functions import physics
from gridgale.functions.keys import mask_text
from gridgale.grid import GridSpec
from gridgale.operators import regions as rg
from gridgale.operators.components import label_cells
from gridgale.operators.flood import FOUND, HOURS, STORMS, level_search, storm_search
from gridgale.operators.frames import frame_values, missing_cells, to_cells, wrap_globe, wrapped_spec
from gridgale.operators.smoothing import SIGMA_PART, gaussian_kernel, smooth
from gridgale.operators.windows import name_storms
from gridgale.session import cut_lineage

# The storm table's fields besides time and id.
HOUR_FIELDS = ["lon_storm", "lat_storm", "amp_storm", "max_wind_speed", "area_storm", "regions_storm"]
# Levels of the multi-level search, Pa; the end is not included.
LEVELS = range(92000, 105000, 400)


def pressure_cells(df: DataFrame, spec: GridSpec) -> DataFrame:
    """Pressure and wind speed of every cell."""
    values = {"msl": F.col("msl"), "wind": physics.wind_speed(F.col("u10"), F.col("v10"))}
    return to_cells(df, spec, values)


def smoothed_cells(df: DataFrame, spec: GridSpec, params: rg.DetectParams) -> tuple[DataFrame, GridSpec]:
    """Smoothed pressure and wind speed, on the grid widened for a globe if asked."""
    cells = smooth(
        pressure_cells(df, spec), spec, "msl", "msl", cut_lon=params.cut_lon, cut_lat=params.cut_lat
    )
    return wrap_globe(cells, spec, params.globe_degrees) if params.globe else (cells, spec)


def region_cells(df: DataFrame, spec: GridSpec, params: rg.DetectParams) -> tuple[DataFrame, GridSpec]:
    """Labelled cells of all candidate regions."""
    cells, spec = smoothed_cells(df, spec, params)
    return label_cells(rg.masked_cells(cells, spec, "msl", params, wind="wind"), spec, rg.FRAME_FACTS), spec


def _searched(df: DataFrame, spec: GridSpec, params: rg.DetectParams, hourly: bool) -> DataFrame:
    """All frames in one pass: read once, shuffled by time once, smoothed, flooded and measured frame by frame."""
    values = {"msl": F.col("msl"), "wind": physics.wind_speed(F.col("u10"), F.col("v10"))}
    along, across = (gaussian_kernel(cut / SIGMA_PART / res) for cut, res in ((params.cut_lon, spec.res_lon), (params.cut_lat, spec.res_lat)))
    search = storm_search(spec, params, along, across, hourly)
    return frame_values(df, spec, values).mapInArrow(search, HOURS if hourly else STORMS)


def _whole_frames(spec: GridSpec, params: rg.DetectParams) -> bool:
    """Whether a frame is worked through as a whole; widened globes and frames larger than a tile are cut up."""
    if params.seam and (params.globe or abs(spec.nx * spec.res_lon - 360.0) > 1e-9):
        raise ValueError("regions can only be joined over the seam of a grid that goes once around")
    return spec.one_tile and not params.globe


def detect(df: DataFrame, spec: GridSpec, params: rg.DetectParams = rg.DetectParams()) -> DataFrame:
    """One row per storm (`time`, `label`): centre, amplitudes, area, strongest wind."""
    if _whole_frames(spec, params):
        return _searched(df, spec, params, hourly=False)
    cells, spec = region_cells(df, spec, params)
    return rg.place(rg.accept(rg.measure_regions(cells, spec, params), spec, params), spec, params)


def first_per_frame(storms: DataFrame) -> DataFrame:
    """The storm whose first cell comes first in raster order."""
    others = [c for c in storms.columns if c not in ("time", "label")]
    first = storms.groupBy("time").agg(F.min_by(F.struct("label", *others), F.col("label")).alias("_f"))
    return first.select("time", "_f.*")


def _ones_at(positions: Column, length: int) -> Column:
    """0/1 array with ones at the given sorted positions, built run by run."""
    def run(x: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(F.get(positions, i - 1))
        return F.concat(F.array_repeat(F.lit(0), x - before - 1), F.array(F.lit(1)))

    last = F.coalesce(F.get(positions, F.size(positions) - 1), F.lit(-1))
    tail = F.array_repeat(F.lit(0), F.lit(length - 1) - last)
    return F.concat(F.flatten(F.transform(positions, run)), tail)


def missing_positions(df: DataFrame, spec: GridSpec, params: rg.DetectParams = rg.DetectParams()) -> DataFrame:
    """(`time`, `missing`): raster positions without pressure, for frames that have any."""
    holes = missing_cells(df, spec, "msl")
    if params.globe:
        holes, spec = wrap_globe(holes, spec, params.globe_degrees)
    return holes.groupBy("time").agg(F.collect_list(spec.raster(F.col("iy"), F.col("ix"))).alias("missing"))


def _all_ones(storms: DataFrame, missing: DataFrame | None) -> DataFrame:
    """Positions that are one in a storm's mask: its interior, and cells without data, which storms of whole
    frames bring along."""
    if missing is not None:
        storms = storms.drop("missing").join(missing, "time", "left")
    elif "missing" not in storms.columns:
        return storms.withColumn("_ones", F.col("interior_cells"))
    none = F.array().cast("array<int>")
    both = F.concat("interior_cells", F.coalesce("missing", none))
    return storms.withColumn("_ones", F.array_sort(both)).drop("missing")


def interior_masks(storms: DataFrame, spec: GridSpec, missing: DataFrame | None = None) -> DataFrame:
    """(`time`, `label`, `mask`): the frame as 0/1, ones at the storm's interior and where data is missing."""
    return _all_ones(storms, missing).select("time", "label", _ones_at(F.col("_ones"), spec.cells).alias("mask"))


def one_row_per_frame(storms: DataFrame, spec: GridSpec) -> DataFrame:
    """The first storm of each frame, with the interiors of all its storms in label order."""
    fields = {
        "lon_storm": "lon",
        "lat_storm": "lat",
        "amp_storm": "amp_abs",
        "max_wind_speed": "max_wind",
        "area_storm": "area_km2",
    }
    listed = storms.groupBy("time").agg(
        F.sort_array(
            F.collect_list(F.struct("label", *[F.col(c).alias(n) for n, c in fields.items()], "interior_cells"))
        ).alias("_s")
    )
    first = F.col("_s")[0]
    return listed.select(
        "time",
        *[first[n].alias(n) for n in fields],
        F.transform("_s", lambda s: s["interior_cells"]).alias("_interiors"),
    )


def mask_texts(interiors: str, missing: str, spec: GridSpec) -> Column:
    """All masks of a frame, stacked in label order, as one text."""
    none = F.array().cast("array<int>")
    masks = F.transform(
        interiors, lambda cells: _ones_at(F.array_sort(F.concat(cells, F.coalesce(missing, none))), spec.cells)
    )
    return mask_text(F.flatten(masks), F.size(interiors), spec.ny, spec.nx)


def hourly_storms(
    df: DataFrame,
    spec: GridSpec,
    params: rg.DetectParams = rg.DetectParams(),
    threshold: float = 1.5,
    prefix: str | None = None,
    emit_quiet_hours: bool = False,
    with_masks: bool = True,
) -> DataFrame:
    """The storm table: at most one row per time, with the storm's running id.

    `threshold` is in degrees; 1 is the stricter usual choice. Ids are the year in which the storm began and its
    number in that year, or `prefix` and its number in all. `emit_quiet_hours` adds a
    `-00` row for each time without a storm.

    Frames are worked through once, and give their storms, their missing cells and, being there, quiet hours together;
    their few rows are written out before ids are given, since naming reads them several times.
    """
    hours = cut_lineage(frame_storms(df, spec, params, with_masks, emit_quiet_hours))
    named = with_mask_texts(name_hours(hours, threshold, prefix), spec, params, with_masks)
    return named.select("time", "id", *HOUR_FIELDS)


def frame_storms(
    df: DataFrame, spec: GridSpec, params: rg.DetectParams, with_masks: bool = True, emit_quiet_hours: bool = False
) -> DataFrame:
    """Each frame's first storm, with the interiors of all its storms and its missing cells; without ids."""
    if _whole_frames(spec, params):
        hours = _searched(df, spec, params, hourly=True)
        if not emit_quiet_hours:
            hours = hours.where(F.col("lon_storm").isNotNull())
        return hours if with_masks else hours.drop("_interiors", "missing")
    cells, out_spec = region_cells(df, spec, params)
    storms = rg.place(rg.accept(rg.measure_regions(cells, out_spec, params), out_spec, params), out_spec, params)
    hours = one_row_per_frame(storms, out_spec)
    if with_masks:
        hours = hours.join(missing_positions(df, spec, params), "time", "left")
    else:
        hours = hours.drop("_interiors")
    return df.select("time").distinct().join(hours, "time", "left") if emit_quiet_hours else hours


def with_mask_texts(hours: DataFrame, spec: GridSpec, params: rg.DetectParams, with_masks: bool = True) -> DataFrame:
    """`hours` with the text of their masks; without masks it is null."""
    if not with_masks:
        return hours.withColumn("regions_storm", F.lit(None).cast("string"))
    out_spec = wrapped_spec(spec, params.globe_degrees) if params.globe else spec
    text = F.when(F.col("lon_storm").isNotNull(), mask_texts("_interiors", "missing", out_spec))
    return hours.withColumn("regions_storm", text).drop("_interiors", "missing")


def name_hours(hours: DataFrame, threshold: float, prefix: str | None) -> DataFrame:
    """`hours` with ids; hours without a storm get the number 00."""
    quiet = hours.where(F.col("lon_storm").isNull())
    of_year = F.concat(F.lit(prefix) if prefix else F.date_format("time", "yyyy"), F.lit("-00"))
    named = name_storms(hours.where(F.col("lon_storm").isNotNull()), threshold, prefix)
    return named.unionByName(quiet.withColumn("id", of_year))


def detect_levels(
    df: DataFrame,
    spec: GridSpec,
    params: rg.DetectParams = rg.DetectParams(require_internal_extremum=True, center="region_min"),
    levels: range = LEVELS,
    topdown: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Search level by level; the interiors of storms found are taken out for later levels.

    Always for low pressure, without smoothing. Levels depend on each other, frames do
    not: a frame goes through all levels in one flood of its cells, so the table is read and
    shuffled once, however many levels there are. Returns the storms, numbered within
    their frame by `idx` in the order they were found, and the cells (`time`, `iy`, `ix`) taken out.
    """
    known = frame_values(df, spec, {"values": F.col("msl")})
    found = known.mapInArrow(level_search(spec, params, [float(x) for x in levels], topdown), FOUND)
    cut = found.select("time", F.explode("interior_cells").alias("_c"))
    taken = cut.select("time", F.floor(F.col("_c") / F.lit(spec.nx)).cast("int").alias("iy"), (F.col("_c") % F.lit(spec.nx)).alias("ix"))
    return found.drop("interior_cells"), taken
