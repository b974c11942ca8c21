"""Grid and track operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridgale.functions import times
from gridgale.grid import GridSpec
from gridgale.operators import frames, links, regions, storms, tracks
from gridgale.operators.regions import DetectParams
from gridgale.operators.smoothing import fill_missing, smooth
from gridgale.sources.coverage import day_bounds, hours_between
from registry import fixture as fx
from registry.catalog import longs, query, rounded
from registry.report_queries import found_lows, id_tracks

DEFAULT = DetectParams()
HIGHS = DetectParams(cyc="anticyclonic", level=101000.0, rel_amp_thresh=50.0)
LEVELS = range(99200, 101600, 400)
LEVEL_LIMITS = DetectParams(require_internal_extremum=True, center="center_of_mass", d_thresh=300.0)


def labelled(spark: SparkSession, sf: str, params: DetectParams = DEFAULT) -> DataFrame:
    return storms.region_cells(fx.grid(spark, sf), fx.SPEC, params)[0]


def measured(spark: SparkSession, sf: str, params: DetectParams = DEFAULT) -> DataFrame:
    return regions.measure_regions(labelled(spark, sf, params), fx.SPEC, params)


def found(spark: SparkSession, sf: str, **limits) -> DataFrame:
    return storms.detect(fx.grid(spark, sf), fx.SPEC, DetectParams(**limits))


def _regions(df: DataFrame, digits: int = 4, **columns: str) -> DataFrame:
    """`time`, `label` and the renamed columns, floats rounded."""
    picked = df.select("time", F.col("label").cast("long").alias("label"), *[F.col(c).alias(n) for n, c in columns.items()])
    floats = [n for n, t in picked.dtypes if t == "double"]
    return rounded(picked, digits, *floats)


@query
def grd1_whole_frames(spark: SparkSession, sf: str) -> DataFrame:
    cells = storms.pressure_cells(fx.grid(spark, sf), fx.SPEC)
    whole = frames.whole_frames(cells, fx.SPEC, "msl")
    values = F.transform("frame", lambda v: F.floor(v).cast("string"))
    return whole.select("time", F.size("frame").cast("long").alias("n"), F.array_join(values, " ").alias("frame"))


@query
def grd2_point_series(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(frames.point_series(fx.grid(spark, sf), fx.SPEC, 22.0, 104.0, "msl"), 4, "msl")


@query
def grd1_copies(spark: SparkSession, sf: str) -> DataFrame:
    """Every seventh cell twice, every thirteenth absent: copies fold to the lower one as it is."""
    g, cell = fx.grid(spark, sf), F.col("iy") * 15 + F.col("ix")
    lower = g.where(cell % 7 == 0).withColumns({"msl": F.col("msl") - 5.0, "u10": -F.col("u10")})
    rows = g.where(cell % 13 != 0).unionByName(lower)
    cells = frames.to_cells(rows, fx.SPEC, {"msl": F.col("msl"), "u10": F.col("u10")})
    return longs(rounded(cells, 4, "msl", "u10"), "iy", "ix")


@query
def grd3_filled(spark: SparkSession, sf: str) -> DataFrame:
    cells = frames.to_cells(fx.grid(spark, sf), fx.SPEC, {"sst": F.col("sst")})
    filled = fill_missing(cells, "sst", "filled")
    return longs(rounded(filled.select("time", "iy", "ix", "filled"), 6, "filled"), "iy", "ix")


@query
def grd3_smoothed_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Cells without a value count as the mean and are missing again afterwards."""
    cells = frames.to_cells(fx.grid(spark, sf), fx.SPEC, {"sst": F.col("sst")})
    out = smooth(cells, fx.SPEC, "sst", "sst")
    return longs(rounded(out.select("time", "iy", "ix", "sst"), 5, "sst"), "iy", "ix")


@query
def grd4_smoothed(spark: SparkSession, sf: str) -> DataFrame:
    cells, _ = storms.smoothed_cells(fx.grid(spark, sf), fx.SPEC, DEFAULT)
    return longs(rounded(cells.select("time", "iy", "ix", "msl"), 3, "msl"), "iy", "ix")


@query
def grd5_masked(spark: SparkSession, sf: str) -> DataFrame:
    return longs(labelled(spark, sf).select("time", "iy", "ix"), "iy", "ix")


@query
def grd5_masked_highs(spark: SparkSession, sf: str) -> DataFrame:
    return longs(labelled(spark, sf, HIGHS).select("time", "iy", "ix"), "iy", "ix")


@query
def grd6_labels(spark: SparkSession, sf: str) -> DataFrame:
    return longs(labelled(spark, sf).select("time", "cell", "label"), "cell", "label")


@query
def grd6_labels_in_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """The way of large grids: squares of 6 x 6 cells, joined across their borders."""
    spec = GridSpec(fx.SPEC.ny, fx.SPEC.nx, fx.SPEC.north, fx.SPEC.west, tile=6)
    cells, _ = storms.region_cells(fx.grid(spark, sf), spec, DEFAULT)
    return longs(cells.select("time", "cell", "label"), "cell", "label")


@query
def grd7_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return _regions(found(spark, sf, npix_min=20), n_cells="n_cells")


@query
def grd8_interior(spark: SparkSession, sf: str) -> DataFrame:
    return longs(labelled(spark, sf).select("time", "cell", "interior"), "cell")


@query
def grd9_rings(spark: SparkSession, sf: str) -> DataFrame:
    m = measured(spark, sf).where(F.col("n_interior") > 0)
    m = m.withColumn("n_ring", F.col("n_cells") - F.col("n_interior"))
    return _regions(m, n_interior="n_interior", n_ring="n_ring")


@query
def grd10_internal_extremum(spark: SparkSession, sf: str) -> DataFrame:
    return _regions(measured(spark, sf), inside="amp_abs", ring="ring_extremum", internal_extremum="internal_extremum")


@query
def grd10_required_for_highs(spark: SparkSession, sf: str) -> DataFrame:
    """Highs, and only with their peak inside; the pressure is turned upside down for it."""
    upside_down = fx.grid(spark, sf).withColumn("msl", F.lit(202600.0) - F.col("msl"))
    limits = DetectParams(cyc="anticyclonic", level=102600.0, require_internal_extremum=True, center="region_min")
    highs = storms.detect(upside_down, fx.SPEC, limits)
    return _regions(highs, n_cells="n_cells", amp_abs="amp_abs", amp_rel="amp_rel", lon="lon", lat="lat")


@query
def grd11_amplitudes(spark: SparkSession, sf: str) -> DataFrame:
    return _regions(found(spark, sf, rel_amp_thresh=500.0), ring_mean="ring_mean", amp_rel="amp_rel")


@query
def grd12_extents(spark: SparkSession, sf: str) -> DataFrame:
    return _regions(found(spark, sf, d_thresh=150.0), extent_km="extent_km")


@query
def grd13_centers(spark: SparkSession, sf: str) -> DataFrame:
    return _regions(found(spark, sf), lon="lon", lat="lat")


@query
def grd14_extremes(spark: SparkSession, sf: str) -> DataFrame:
    return _regions(found(spark, sf), amp="amp_abs")


@query
def grd15_areas(spark: SparkSession, sf: str) -> DataFrame:
    return _regions(found(spark, sf), area="area_km2")


@query
def grd16_interior_masks(spark: SparkSession, sf: str) -> DataFrame:
    masks = storms.interior_masks(found(spark, sf), fx.SPEC)
    text = F.array_join(F.col("mask").cast("array<string>"), "")
    return longs(masks.select("time", "label", text.alias("mask")), "label")


def gappy(spark: SparkSession, sf: str) -> DataFrame:
    """The grid without pressure in some cells."""
    g = fx.grid(spark, sf)
    place = F.col("frame") * 7 + F.col("iy") * 15 + F.col("ix")
    return g.withColumn("msl", F.when(place % 41 != 0, F.col("msl")))


@query
def grd16_masks_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Cells without pressure are part of every mask of their frame."""
    masks = storms.interior_masks(storms.detect(gappy(spark, sf), fx.SPEC), fx.SPEC)
    text = F.array_join(F.col("mask").cast("array<string>"), "")
    return longs(masks.select("time", "label", text.alias("mask")), "label")


@query
def grd17_wind_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """The strongest wind is also looked for where pressure is missing."""
    return _regions(storms.detect(gappy(spark, sf), fx.SPEC), 6, max_wind="max_wind")


@query
def grd17_strongest_wind(spark: SparkSession, sf: str) -> DataFrame:
    return _regions(found(spark, sf), 6, max_wind="max_wind")


@query
def grd18_mask_texts(spark: SparkSession, sf: str) -> DataFrame:
    hours = storms.hourly_storms(fx.grid(spark, sf), fx.SPEC, prefix="2022")
    return hours.select("time", "regions_storm")


@query
def grd19_wrapped_globe(spark: SparkSession, sf: str) -> DataFrame:
    """The same cells spread over the whole circle, 24 degrees apart."""
    globe = GridSpec(20, 15, 24.0, 0.0, res_lon=24.0)
    around = fx.grid(spark, sf).withColumn("longitude", F.col("ix") * F.lit(24.0))
    wide, spec = frames.wrap_globe(storms.pressure_cells(around, globe), globe, degrees=48.0)
    out = wide.select("time", "iy", "ix", spec.longitude(F.col("ix")).alias("longitude"), "msl", "wind")
    return longs(rounded(out, 4, "msl", "wind"), "iy", "ix")


@query
def grd19_over_the_seam(spark: SparkSession, sf: str) -> DataFrame:
    """Lows that lie on the seam of a grid around the globe, each found once."""
    globe = GridSpec(20, 15, 24.0, 0.0, res_lon=24.0)
    turned = fx.grid(spark, sf).withColumn("longitude", (F.col("ix") + 8) % 15 * F.lit(24.0))
    lows = storms.detect(turned, globe, DetectParams(seam=True, center="region_min", d_thresh=30000.0))
    return rounded(
        _regions(lows, n_cells="n_cells", amp_abs="amp_abs", amp_rel="amp_rel", extent_km="extent_km", lat="lat", lon="lon"), 3, "extent_km"
    )


@query
def grd20_hours_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Gaps, quiet hours and storms of frames without pressure in some cells, from one scan."""
    hours = storms.hourly_storms(gappy(spark, sf), fx.SPEC, prefix="2022", emit_quiet_hours=True)
    return rounded(hours, 4, "amp_storm", "max_wind_speed", "area_storm")


@query
def grd20_hourly_storms(spark: SparkSession, sf: str) -> DataFrame:
    hours = storms.hourly_storms(fx.grid(spark, sf), fx.SPEC, prefix="2022", emit_quiet_hours=True)
    return rounded(hours, 4, "amp_storm", "max_wind_speed", "area_storm")


@query
def grd21_levels(spark: SparkSession, sf: str) -> DataFrame:
    lows, _ = storms.detect_levels(fx.grid(spark, sf), fx.SPEC, LEVEL_LIMITS, LEVELS)
    out = lows.select("time", "label", "level", "idx", "n_cells", "lon", "lat", "amp_abs", "area_km2")
    return longs(rounded(out, 3, "lon", "lat", "amp_abs", "area_km2"), "label", "idx")


@query
def grd21_cells_taken_out(spark: SparkSession, sf: str) -> DataFrame:
    _, taken = storms.detect_levels(fx.grid(spark, sf), fx.SPEC, LEVEL_LIMITS, LEVELS)
    return longs(taken, "iy", "ix")


@query
def grd22_centers_of_mass(spark: SparkSession, sf: str) -> DataFrame:
    return _regions(found(spark, sf, center="center_of_mass"), 5, lon="lon", lat="lat")


@query
def grd23_region_minima(spark: SparkSession, sf: str) -> DataFrame:
    return _regions(found(spark, sf, center="region_min"), lon="lon", lat="lat")


@query
def grd24_eccentricity_limit(spark: SparkSession, sf: str) -> DataFrame:
    return _regions(found(spark, sf, d_thresh=0.62), extent_km="extent_km")


@query
def grd25_storms_of_all_hours(spark: SparkSession, sf: str) -> DataFrame:
    hours = storms.hourly_storms(fx.grid(spark, sf), fx.SPEC, prefix="2022")
    return rounded(hours, 4, "amp_storm", "max_wind_speed", "area_storm")


@query
def trk1_detections(spark: SparkSession, sf: str) -> DataFrame:
    d = found_lows(spark, sf).select("time", "idx", "lon", "lat", "amp", "area", "type", "n")
    return longs(rounded(d, 4, "amp", "area"), "idx", "n")


@query
def trk1_half_hours(spark: SparkSession, sf: str) -> DataFrame:
    """Frames half an hour apart, in steps of half an hour: every detection a node of its own."""
    found = storms.detect(fx.grid(spark, sf), fx.SPEC, regions.DetectParams(center="region_min"))
    start = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")
    half = F.timestamp_add("MINUTE", (F.timestamp_diff("MINUTE", start, "time") / 2).cast("int"), start)
    d = links.detections(found.withColumn("time", half), dt=0.5)
    return longs(d.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("node").alias("nodes"), F.count_distinct("step").alias("steps"), F.max("idx").alias("last")
    ), "last")


@query
def trk2_initial_tracks(spark: SparkSession, sf: str) -> DataFrame:
    points = tracks.track(found_lows(spark, sf))
    starts = points.where("seq = 0").select("track_id", "time", "lon", "lat", "exist_at_start")
    return longs(starts, "track_id")


@query
def trk3_tracks(spark: SparkSession, sf: str) -> DataFrame:
    points = tracks.track(found_lows(spark, sf))
    return longs(points.select("track_id", "seq", "time", "idx", "lon", "lat", "type", "exist_at_start"), "track_id", "idx")


@query
def trk3_tracks_far_reach(spark: SparkSession, sf: str) -> DataFrame:
    """With 400 km an hour the two lows of a frame compete for their successors."""
    points = tracks.track(found_lows(spark, sf), prop_speed=400.0)
    return longs(points.select("track_id", "seq", "time", "idx", "lon", "lat", "type", "exist_at_start"), "track_id", "idx")


@query
def trk3_crowded_year(spark: SparkSession, sf: str) -> DataFrame:
    """A year without a quiet hour, in an area so small that most choices are contested at the usual speed."""
    points = tracks.track(fx.crowd(spark, sf))
    return longs(points.select("track_id", "seq", "time", "idx", "lon", "lat", "type", "exist_at_start"), "track_id", "idx")


@query
def trk4_lasting_tracks(spark: SparkSession, sf: str) -> DataFrame:
    kept = tracks.lasting_tracks(tracks.track_summary(id_tracks(spark, sf)), d_tot_min=150.0, d_ratio=0.3, dur_min=2.0)
    return rounded(kept, 3, "length_km", "straight_km")


@query
def trk4_stripped_points(spark: SparkSession, sf: str) -> DataFrame:
    kept = tracks.strip(id_tracks(spark, sf), d_tot_min=150.0, d_ratio=0.3, dur_min=2.0)
    return longs(kept.select("track_id", "seq", "time", "lon", "lat"), "seq")


@query
def trk5_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Every day the long table covers."""
    climate = fx.climate(spark, sf)
    days = hours_between(day_bounds(climate, F.col("time"))).select(F.to_date("time").alias("date")).distinct()
    return days.select(
        times.proleptic_ordinal(F.col("date")).cast("long").alias("ordinal"),
        "date",
        F.year("date").cast("long").alias("year"),
        F.month("date").cast("long").alias("month"),
        F.dayofmonth("date").cast("long").alias("day"),
        times.leap_day_of_year(F.col("date")).cast("long").alias("doy"),
    )
