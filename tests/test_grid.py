import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from conftest import plan_of
from gridgale.grid import GridSpec
from gridgale.operators import components, flood, frames, regions, storms
from gridgale.operators.regions import DetectParams
from gridgale.operators.smoothing import gaussian_kernel, reflect, smooth

START = dt.datetime(2024, 1, 1)
SCHEMA = "time timestamp_ntz, latitude double, longitude double, msl double, u10 double, v10 double"


def table(spark, spec, stack, wind=3.0, copies=1, leave_out=lambda t, y, x: False):
    """Observations of a stack of frames; NaN cells come as null."""
    rows = []
    for t, frame in enumerate(stack):
        for (y, x), v in np.ndenumerate(frame):
            if leave_out(t, y, x):
                continue
            v = None if np.isnan(v) else float(v)
            row = (START + dt.timedelta(hours=t), spec.north - spec.res_lat * y, spec.west + spec.res_lon * x, v, wind, 4.0)
            rows += [row] * copies
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def stack_of(cells, spec, value, count):
    out = np.full((count, spec.ny, spec.nx), np.nan)
    for r in cells.select("time", "iy", "ix", value).collect():
        if r[value] is not None:
            out[int((r["time"] - START).total_seconds() // 3600), r["iy"], r["ix"]] = r[value]
    return out


def field(seed, count, ny, nx, scale=900.0):
    rng = np.random.default_rng(seed)
    rough = rng.normal(100000.0, scale, (count, ny, nx))
    return np.stack([brute.smooth(f, gaussian_kernel(1.0)) for f in rough])


def test_kernel_and_mirror():
    k = gaussian_kernel(0.8)
    assert len(k) == 7 and sum(k) == pytest.approx(1.0) and gaussian_kernel(0.0) == [1.0]
    assert [reflect(i, 4) for i in range(-5, 9)] == [3, 3, 2, 1, 0, 0, 1, 2, 3, 3, 2, 1, 0, 0]


@pytest.mark.parametrize("shape", [(9, 11), (2, 3), (1, 8), (4, 1)])
def test_smoothing_equals_convolution(spark, shape):
    spec = GridSpec(*shape, 24.0, 102.0)
    stack = field(3, 3, *shape)
    cells = smooth(frames.to_cells(table(spark, spec, stack), spec, {"msl": F.col("msl")}), spec, "msl", "msl")
    want = np.stack([brute.smooth(f, gaussian_kernel(0.8)) for f in stack])
    np.testing.assert_allclose(stack_of(cells, spec, "msl", 3), want, rtol=1e-12)


def test_smoothing_keeps_the_sum(spark):
    spec = GridSpec(10, 12, 24.0, 102.0)
    stack = field(4, 2, 10, 12)
    cells = smooth(frames.to_cells(table(spark, spec, stack), spec, {"msl": F.col("msl")}), spec, "msl", "msl")
    np.testing.assert_allclose(stack_of(cells, spec, "msl", 2).sum(axis=(1, 2)), stack.sum(axis=(1, 2)), rtol=1e-12)


def test_gaps_and_copies_do_not_shift_cells(spark):
    """Null cells, absent cells, an absent grid row and copies all give the same as a masked frame."""
    spec = GridSpec(8, 9, 24.0, 102.0)
    stack = field(5, 3, 8, 9)
    stack[0, 2, 3] = stack[0, 7, 8] = np.nan
    gone = lambda t, y, x: t == 1 and (y == 4 or (y, x) == (0, 0))
    df = table(spark, spec, stack, copies=3, leave_out=gone)
    masked = stack.copy()
    masked[1, 4, :] = masked[1, 0, 0] = np.nan
    cells = smooth(frames.to_cells(df, spec, {"msl": F.col("msl")}), spec, "msl", "msl")
    want = np.stack([brute.smooth(f, gaussian_kernel(0.8)) for f in masked])
    np.testing.assert_allclose(stack_of(cells, spec, "msl", 3), want, rtol=1e-12)
    state = {r["time"]: r for r in frames.completeness(df, spec).collect()}
    assert [state[START + dt.timedelta(hours=t)]["complete"] for t in range(3)] == [True, False, True]
    assert not any(r["regular"] for r in state.values())
    assert all(r["regular"] for r in frames.completeness(table(spark, spec, stack), spec).collect())


@pytest.mark.parametrize("nx", [9, 64, 70])
def test_missing_cells_are_all_found(spark, nx):
    spec = GridSpec(5, nx, 24.0, 0.0)
    stack = np.ones((3, 5, nx))
    stack[0, 1, nx - 1] = stack[0, 4, 0] = np.nan
    gone = lambda t, y, x: t == 1 and (y == 2 or (y, x) == (0, 3))
    df = table(spark, spec, stack, copies=2, leave_out=gone)
    got = {(int((r["time"] - START).total_seconds() // 3600), r["iy"], r["ix"]) for r in frames.missing_cells(df, spec, "msl").collect()}
    assert got == {(0, 1, nx - 1), (0, 4, 0), (1, 0, 3)} | {(1, 2, x) for x in range(nx)}


def test_completeness_is_not_fooled_by_a_copy_for_a_gap(spark):
    spec = GridSpec(2, 70, 24.0, 0.0)
    df = table(spark, spec, np.ones((1, 2, 70)))
    last = F.col("longitude") == spec.longitude(F.lit(69))
    swapped = df.withColumn("longitude", F.when(last, F.lit(0.0)).otherwise(F.col("longitude")))
    row = frames.completeness(swapped, spec).first()
    assert (row["rows"], row["cells"], row["complete"], row["regular"]) == (140, 138, False, False)


@pytest.mark.parametrize("tile", [1024, 5, 3, 1])
def test_labels_equal_flood_fill(spark, tile):
    spec = GridSpec(14, 17, 24.0, 102.0, tile=tile)
    rng = np.random.default_rng(tile)
    stack = np.where(rng.random((4, 14, 17)) < 0.62, 99000.0, 101000.0)
    cells = frames.to_cells(table(spark, spec, stack), spec, {"msl": F.col("msl")})
    labelled = components.label_cells(regions.masked_cells(cells, spec, "msl", DetectParams()), spec, regions.FRAME_FACTS)
    got = {}
    for r in labelled.collect():
        got[(int((r["time"] - START).total_seconds() // 3600), r["iy"], r["ix"])] = (r["label"], r["interior"])
    want = {}
    for t, frame in enumerate(stack):
        for cells_ in brute.regions(frame < 100000.0):
            interior, _ = brute.split(cells_)
            first = cells_[0][0] * 17 + cells_[0][1]
            for c in cells_:
                want[(t, *c)] = (first, c in interior)
    assert got == want


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_components_of_a_long_chain(spark, keys):
    edges = spark.range(200).selectExpr("0 AS k", "id AS a", "id + 1 AS b").sample(0.97, seed=2)
    got = components.components(edges.select(*keys, "a", "b"), keys)
    roots = {r["node"]: r["root"] for r in got.collect()}
    parent = {}
    for r in sorted((e["a"], e["b"]) for e in edges.collect()):
        parent[r[1]] = r[0]
    for node, root in roots.items():
        while node in parent:
            node = parent[node]
        assert root == node


@pytest.mark.parametrize("step", [1, -1])
def test_a_long_path_settles_in_few_rounds(spark, monkeypatch, step):
    """Labels that rise or fall along the path, and one whose smallest label is at an end."""
    steps = []
    cut = components.cut_lineage
    monkeypatch.setattr(components, "cut_lineage", lambda df: steps.append(1) or cut(df))
    edges = spark.range(1999).selectExpr(f"{step} * id AS a", f"{step} * (id + 1) AS b")
    got = components.components(edges, [])
    assert got.agg(F.count("*"), F.min("root"), F.max("root")).first() == (2000, *[min(0, step * 1999)] * 2)
    assert len(steps) <= 2 + 2 * 25


def measured(spark, spec, stack, params):
    cells = frames.to_cells(table(spark, spec, stack), spec, {"msl": F.col("msl")})
    cells = regions.masked_cells(cells, spec, "msl", params)
    return regions.measure_regions(components.label_cells(cells, spec, regions.FRAME_FACTS), spec, params)


@pytest.mark.parametrize("west,res", [(102.0, 0.25), (0.0, 20.0)])
def test_measures_equal_brute_force(spark, west, res):
    """Also on a grid around the globe, where row ends are not the farthest points."""
    spec = GridSpec(12, 18, 60.0, west, res_lat=10.0 if res > 1 else 0.25, res_lon=res)
    stack = field(7, 4, 12, 18)
    rows = measured(spark, spec, stack, DetectParams()).collect()
    got = {(int((r["time"] - START).total_seconds() // 3600), r["label"]): r for r in rows}
    count = 0
    for t, frame in enumerate(stack):
        for cells in brute.regions(frame < 100000.0):
            r = got[(t, cells[0][0] * 18 + cells[0][1])]
            interior, ring = brute.split(cells)
            count += 1
            assert (r["n_cells"], r["n_interior"]) == (len(cells), len(interior))
            assert r["interior_cells"] == [y * 18 + x for y, x in sorted(interior)]
            if interior:
                low, edge = min(frame[c] for c in interior), [frame[c] for c in ring]
                assert r["amp_abs"] == pytest.approx(low)
                assert r["amp_rel"] == pytest.approx(np.mean(edge) - low)
                assert r["internal_extremum"] == (low < min(edge))
                assert r["extent_km"] == pytest.approx(brute.extent(ring, spec), abs=1e-3)
    assert count == len(got) > 4


def test_low_on_the_ring_is_no_internal_extremum(spark):
    spec = GridSpec(9, 9, 24.0, 102.0)
    frame = np.full((9, 9), 101000.0)
    frame[2:7, 2:7] = 99000.0
    frame[2, 4] = 98000.0
    params = DetectParams(rel_amp_thresh=-1e9)
    row = measured(spark, spec, frame[None], params).first()
    assert row["internal_extremum"] is False
    cells = measured(spark, spec, frame[None], params)
    needed = DetectParams(rel_amp_thresh=-1e9, require_internal_extremum=True)
    assert regions.accept(cells, spec, params).count() == 1
    assert regions.accept(cells, spec, needed).count() == 0


def test_highs_mirror_lows(spark):
    spec = GridSpec(12, 14, 24.0, 102.0)
    stack = field(8, 3, 12, 14)
    lows = DetectParams(rel_amp_thresh=0.0, npix_min=5, center="region_min")
    highs = DetectParams(rel_amp_thresh=0.0, npix_min=5, center="region_min", cyc="anticyclonic")
    keep = ["time", "label", "n_cells", "lon", "lat"]
    a = storms.detect(table(spark, spec, stack), spec, lows).select(*keep).collect()
    b = storms.detect(table(spark, spec, 200000.0 - stack), spec, highs).select(*keep).collect()
    assert sorted(a) == sorted(b) and len(a) > 0


def test_frame_minimum_of_highs_is_the_whole_frames(spark):
    spec = GridSpec(8, 8, 24.0, 102.0)
    frame = np.full((8, 8), 99000.0)
    frame[0, 7] = 90000.0
    frame[2:7, 1:6] = 103000.0
    params = DetectParams(cyc="anticyclonic", rel_amp_thresh=0.0, cut_lon=0.0, cut_lat=0.0)
    row = storms.detect(table(spark, spec, frame[None]), spec, params).first()
    assert (row["lat"], row["lon"]) == (24.0, 103.75)


def test_missing_cells_join_the_mask_and_its_wind(spark):
    spec = GridSpec(9, 9, 24.0, 102.0)
    frame = np.full((9, 9), 101000.0)
    frame[2:7, 2:7] = 98000.0
    frame[0, 0] = np.nan
    df = table(spark, spec, frame[None]).withColumn(
        "u10", F.when(F.col("msl").isNull(), F.lit(30.0)).otherwise(F.col("u10"))
    )
    params = DetectParams(cut_lon=0.0, cut_lat=0.0, rel_amp_thresh=0.0)
    row = storms.hourly_storms(df, spec, params).first()
    assert row["max_wind_speed"] == pytest.approx((30.0**2 + 4.0**2) ** 0.5)
    assert row["regions_storm"].startswith("(1, 9, 9)_[1, 0")
    assert row["regions_storm"].count("1,") - row["regions_storm"].startswith("(1,") == 1 + 9


def test_copies_fold_to_one_whole_row(spark):
    rows = [(START, 24.0, 102.0, p, w) for p, w in ((3.0, 1.0), (None, 0.5), (2.0, 9.0), (2.0, None))] + [(START, 80.0, 102.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, latitude double, longitude double, p double, w double")
    got = frames.to_cells(df, GridSpec(1, 2, 24.0, 102.0), {"p": F.col("p"), "w": F.col("w")}).collect()
    assert sorted((r["iy"], r["ix"], r["p"], r["w"]) for r in got) == [(0, 0, 2.0, 9.0), (0, 1, None, None)]


@pytest.mark.parametrize("topdown", [True, False])
@pytest.mark.parametrize("d", [2500.0, 160.0])
def test_levels_equal_brute_force(spark, topdown, d):
    spec = GridSpec(14, 16, 24.0, 102.0)
    stack = field(11, 3, 14, 16, scale=2500.0)
    span = range(98000, 103200, 400)
    params = DetectParams(require_internal_extremum=True, center="region_min", npix_min=5, rel_amp_thresh=50.0, d_thresh=d)
    found, taken = storms.detect_levels(table(spark, spec, stack), spec, params, span, topdown=topdown)
    hour = lambda t: int((t - START).total_seconds() // 3600)
    got = {}
    for r in found.orderBy("time", "idx").collect():
        got.setdefault(hour(r["time"]), []).append((r["level"], r["label"], round(r["amp_abs"], 6), r["n_cells"]))
    out = {(hour(r["time"]), r["iy"], r["ix"]) for r in taken.collect()}
    want, gone = {}, set()
    for t, frame in enumerate(stack):
        storms_, cells = brute.levels(frame, spec, sorted(span, reverse=topdown), 5, 6000, 50.0, d)
        if storms_:
            want[t] = [(float(a), b, c, n) for a, b, c, n in storms_]
        gone |= {(t, *c) for c in cells}
    assert got == want and out == gone and sum(map(len, want.values())) > 1


@pytest.mark.parametrize("seed", range(4))
def test_levels_of_rough_frames_with_gaps(spark, monkeypatch, seed):
    """Many storms inside each other's remains; frames flooded one by one and together."""
    spec = GridSpec(22, 19, 24.0, 102.0)
    rng = np.random.default_rng(seed)
    stack = np.round(field(seed, 4, 22, 19, scale=3000.0), -2)  # ties
    stack[rng.random(stack.shape) < 0.03] = np.nan
    stack[3] = np.nan
    params = DetectParams(require_internal_extremum=True, npix_min=5, rel_amp_thresh=20.0, d_thresh=400.0)
    monkeypatch.setattr(flood, "BATCH_CELLS", (1 << 19) if seed % 2 else 1)
    for topdown in (True, False):
        found, taken = storms.detect_levels(table(spark, spec, stack), spec, params, range(96000, 104000, 200), topdown=topdown)
        got = [[], [], [], []]
        for r in found.orderBy("time", "idx").collect():
            got[int((r["time"] - START).total_seconds() // 3600)].append((r["level"], r["label"], round(r["amp_abs"], 6), r["n_cells"]))
        want = [brute.levels(f, spec, sorted(range(96000, 104000, 200), reverse=topdown), 5, 6000, 20.0, 400.0)[0] for f in stack]
        assert got == [[(float(a), *rest) for a, *rest in w] for w in want] and sum(map(len, got)) > 2


def test_levels_read_and_shuffle_once_and_start_no_job(spark):
    spec = GridSpec(14, 16, 24.0, 102.0)
    df = table(spark, spec, field(11, 3, 14, 16))
    spark.sparkContext.setJobGroup("levels", "levels")
    found, taken = storms.detect_levels(df, spec)
    assert not list(spark.sparkContext.statusTracker().getJobIdsForGroup("levels"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for out in (found, taken):
        plan = plan_of(out)
        assert plan.count("Exchange") == 1 and plan.count("Scan") == 1, plan


@pytest.mark.parametrize("nx,res", [(18, 20.0), (73, 5.0), (40, 6.0), (30, 0.25), (360, 1.0)])
def test_ring_extent_equals_all_pairs(nx, res):
    spec = GridSpec(19, nx, 90.0, 0.0, res_lat=10.0, res_lon=res)
    rng = np.random.default_rng(nx)
    for n in (1, 2, 5, 40):
        iy, ix = rng.integers(0, 19, n), rng.integers(0, nx, n)
        want = brute.extent(list(zip(iy.tolist(), ix.tolist())), spec)
        assert flood.rings_apart_km(iy, ix, spec) == pytest.approx(want, abs=1e-3)


def test_globe_wrap(spark):
    spec = GridSpec(1, 18, 10.0, 0.0, res_lon=20.0)
    df = table(spark, spec, np.arange(18.0)[None, None, :])
    wide, wspec = frames.wrap_globe(frames.to_cells(df, spec, {"msl": F.col("msl")}), spec, 40.0)
    row = [r["msl"] for r in wide.orderBy("ix").collect()]
    assert row == [16.0, 17.0, *map(float, range(18)), 0.0, 1.0]
    assert (wspec.west, wspec.nx) == (-40.0, 22)
