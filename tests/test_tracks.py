import datetime as dt
import random

import pytest

import brute
from gridgale.operators import links, tracks

START = dt.datetime(2024, 1, 1)


def detections(spark, frames):
    rows = [
        (START + dt.timedelta(hours=t), i, lon, lat, 1.0, 2.0)
        for t, dets in enumerate(frames)
        for i, (lon, lat) in enumerate(dets)
    ]
    schema = "time timestamp_ntz, label int, lon double, lat double, amp_abs double, area_km2 double"
    return links.detections(spark.createDataFrame(rows, schema))


def crowd(seed, steps, most, box, south=10.0, west=102.0, fewest=0):
    rnd = random.Random(seed)
    return [
        [(west + rnd.random() * box, south + rnd.random() * box) for _ in range(rnd.randint(fewest, most))]
        for _ in range(steps)
    ]


@pytest.mark.parametrize(
    "frames",
    [
        crowd(1, 40, 6, 3.0, fewest=2),
        crowd(2, 30, 14, 3.0, fewest=8),
        crowd(3, 25, 5, 6.0, south=80.0),
        crowd(4, 25, 5, 2.0, west=179.0),
    ],
    ids=["sparse", "dense", "polar", "date line"],
)
def test_tracks_equal_the_sequential_rule(spark, frames):
    got = {}
    first = None
    for r in tracks.track(detections(spark, frames)).collect():
        hour = int((r["time"] - START).total_seconds() // 3600)
        got[(hour, r["idx"])] = r["track_id"]
        first = hour if first is None else min(first, hour)
        assert r["n"] == len(frames[hour])
    assert got == brute.tracks(frames, 80.0)


def test_steps_may_span_batches_and_runs(spark, monkeypatch):
    """Arrow batches of a few links, runs of a few steps, and steps that end all tracks."""
    monkeypatch.setattr(tracks, "RUN", 4)
    frames = crowd(5, 60, 7, 2.0, fewest=3)
    for t in (9, 10, 30, 44):
        frames[t] = []
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        rows = tracks.track(detections(spark, frames)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(int((r["time"] - START).total_seconds() // 3600), r["idx"]): r["track_id"] for r in rows} == brute.tracks(frames, 80.0)


def test_contests_cost_no_jobs(spark):
    """As many jobs for tracks that compete at every step as for one that is alone."""
    counts = []
    for name, frames in (("alone", [[(105.0 + 0.1 * t, 15.0)] for t in range(20)]), ("crowd", crowd(2, 30, 14, 3.0, fewest=8))):
        found = detections(spark, frames)
        spark.sparkContext.setJobGroup(name, name)
        tracks.track(found)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)))
    assert counts[0] == counts[1]


def test_links_find_all_pairs_across_the_date_line(spark):
    frames = [[(179.9, 0.0), (0.1, 0.0)], [(-179.9, 0.1), (359.95, 0.0), (10.0, 0.0)]]
    found = links.candidate_links(detections(spark, frames))
    base = detections(spark, frames).agg({"step": "min"}).first()[0]
    node = lambda step, idx: ((base + step) << 24) + idx
    assert {(r["u"], r["v"]) for r in found.collect()} == {(node(0, 0), node(1, 0)), (node(0, 1), node(1, 1))}


def test_a_step_without_detections_ends_all_tracks(spark):
    frames = [[(105.0, 15.0)], [(105.1, 15.0)], [], [(105.1, 15.0)]]
    rows = tracks.track(detections(spark, frames)).orderBy("time").collect()
    assert [(r["track_id"], r["seq"], r["exist_at_start"]) for r in rows] == [(0, 0, True), (0, 1, True), (1, 0, False)]


def points(spark, *paths):
    rows = [(n, k, float(lon), float(lat)) for n, path in enumerate(paths) for k, (lon, lat) in enumerate(path)]
    return spark.createDataFrame(rows, "track_id int, seq int, lon double, lat double")


def test_lasting_tracks_at_their_limits(spark):
    straight = [(100 + i, 0) for i in range(11)]
    zigzag = [(100 + i % 2, 0) for i in range(11)]
    still = [(100, 0)] * 11
    summary = tracks.track_summary(points(spark, straight, zigzag, still, [(100, 0)]))
    length = {r["track_id"]: r["length_km"] for r in summary.collect()}
    assert length[0] == pytest.approx(brute.km(100, 0, 110, 0, 6371.0)) and length[2] == length[3] == 0.0
    kept = lambda **k: {r["track_id"] for r in tracks.lasting_tracks(summary, **k).collect()}
    assert kept(dur_min=10) == {0}
    assert kept(dur_min=11) == set()
    assert kept(dur_min=20, dt=2.0) == {0}
    assert kept(dur_min=0, d_tot_min=length[0]) <= {0, 1}
    assert kept(dur_min=0, d_tot_min=0.0, d_ratio=0.0) == {0, 1}


def test_strip_keeps_whole_tracks(spark):
    frames = [[(105.0 + 0.3 * t, 15.0)] + ([(150.0, 15.0)] if t == 4 else []) for t in range(8)]
    kept = tracks.strip(tracks.track(detections(spark, frames)), d_tot_min=10.0, dur_min=3.0)
    assert [(r["track_id"], r["seq"]) for r in kept.orderBy("seq").collect()] == [(0, k) for k in range(8)]


def test_a_crowd_is_followed_without_its_links(spark, monkeypatch):
    """Detections at few places, many at each: pairs within reach would grow with the square of a step."""
    def no_links(*_):
        raise AssertionError("all pairs within reach")

    monkeypatch.setattr(links, "candidate_links", no_links)
    monkeypatch.setattr(tracks, "candidate_links", no_links, raising=False)
    rnd = random.Random(8)
    frames = [[(105.0 + rnd.randrange(3) * 0.5, 15.0 + rnd.randrange(3) * 0.5) for _ in range(30 + t)] for t in range(6)]
    rows = tracks.track(detections(spark, frames)).collect()
    assert {(int((r["time"] - START).total_seconds() // 3600), r["idx"]): r["track_id"] for r in rows} == brute.tracks(frames, 80.0)


def test_detections_without_a_place_are_not_followed(spark):
    frames = [[(105.0, 15.0), (None, 15.0)], [(105.0, float("nan")), (105.1, 15.0), (105.0, None)]]
    rows = tracks.track(detections(spark, frames)).collect()
    assert sorted((r["track_id"], r["seq"]) for r in rows) == [(0, 0), (0, 1), (1, 0), (2, 0), (3, 0)]
