"""Storm tracks: detections linked through time, oldest track first.

At every step the live tracks choose in the order they began: each takes the nearest
detection still free within its reach, and a track that finds none has ended. The rule is
sequential, but not for the whole record: at a step that nothing before it can reach, no track is
alive. Such steps cut the record into segments, and a segment is one pass over its detections in
order of time, which keeps nothing but those of two steps. So the plan has no loop, however
many tracks compete, and pairs within reach are never written down.

A node is a detection; node numbers sort by (step, idx), so the number of a track's
first node is also its rank.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridgale.functions.geo import RADIUS_TRACKS, distance_km
from gridgale.operators.links import PROP_SPEED, step_of, steps_in_reach
from gridgale.operators.windows import running_total, with_month
from gridgale.session import cut_lineage

# What is stripped. Hours, km, and straight distance over track length.
DUR_MIN = 72.0
D_TOT_MIN = 1000.0
D_RATIO = 0.6
# Steps in a row whose ends are looked for together.
RUN = 1024
# Cosines nearer than this are told apart by the distance itself.
CLOSE = 1e-14


def segments(reached: DataFrame) -> DataFrame:
    """(`step`, `segment`) for steps that may be led to; a segment is a row of such steps without a gap.

    Steps are first put in a row inside runs of `RUN` steps; one row for each of those goes on.
    """
    run = F.call_function("div", F.col("step"), F.lit(RUN)).alias("run")
    steps = reached.select("step", run)
    inside = Window.partitionBy("run").orderBy("step")
    marked = steps.withColumn("_begins", F.coalesce(F.col("step") - F.lag("step").over(inside) > 1, F.lit(True)))
    # The first of a run goes on with the run before, if that ends just before it.
    lasts = steps.groupBy((F.col("run") + 1).alias("run")).agg(F.max("step").alias("_last"))
    firsts = F.row_number().over(inside) == 1
    joined = marked.withColumn("_first", firsts).join(lasts, "run", "left")
    goes_on = F.col("_first") & F.coalesce(F.col("_last") == F.col("step") - 1, F.lit(False))
    begun = joined.withColumn("_number", F.when(F.col("_begins") & ~goes_on, F.lit(1)).otherwise(F.lit(0)))
    return running_total(begun, "_number", "segment", ["step"], "run").select("step", "segment")


class Places:
    """The free detections of a step by place, in order of latitude. Detections of one place are taken in order of node."""

    def __init__(self, node: list[int], lon: list[float], lat: list[float]):
        waiting: dict[tuple[float, float], list[int]] = {}
        for n, x, y in sorted(zip(node, lon, lat), reverse=True):
            waiting.setdefault((x, y), []).append(n)
        at = sorted(waiting, key=lambda place: place[1])
        self.waiting = [waiting[place] for place in at]
        self.lon = [x for x, _ in at]
        self.lat = np.array([y for _, y in at])
        self.sin, self.cos = [math.sin(math.radians(y)) for _, y in at], [math.cos(math.radians(y)) for _, y in at]
        self.points = _points(np.array(self.lon), self.lat)
        self.gone = np.zeros(len(at))  # taken off a place's cosine once nothing is left there

    def take_nearest(self, lon: float, lat: float, point: np.ndarray, reach: float) -> int | None:
        """The nearest free node within reach, the first of equally near ones; it is not free any more.

        Cosines from vectors tell which places may be nearest; `distance_km` decides.
        """
        high = math.degrees(reach / RADIUS_TRACKS) + 1e-9
        a, b = self.lat.searchsorted(lat - high), self.lat.searchsorted(lat + high, "right")
        if a == b:
            return None
        cosine = self.points[a:b] @ point - self.gone[a:b]
        greatest = cosine.max()
        if greatest < math.cos(min(math.pi, reach / RADIUS_TRACKS)) - CLOSE:
            return None
        s, c = math.sin(math.radians(lat)), math.cos(math.radians(lat))
        best = None
        for i in (np.flatnonzero(cosine >= greatest - CLOSE) + a).tolist():
            angle = s * self.sin[i] + math.cos(math.radians(lon - self.lon[i])) * c * self.cos[i]
            km = RADIUS_TRACKS * math.acos(max(-1.0, min(1.0, angle)))
            if self.waiting[i] and km <= reach and (best is None or (km, self.waiting[i][-1]) < best[:2]):
                best = km, self.waiting[i][-1], i
        if best is None:
            return None
        _, node, i = best
        self.waiting[i].pop()
        if not self.waiting[i]:
            self.gone[i] = 4.0
        return node


def _points(lon: np.ndarray, lat: np.ndarray) -> np.ndarray:
    x, y = np.radians(lon), np.radians(lat)
    return np.stack([np.cos(y) * np.cos(x), np.cos(y) * np.sin(x), np.sin(y)], axis=1)


def _follow(reach: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(`node`, `track`) of the detections that continue a track, from detections in order of segment and step.

    Of a step all detections are needed, of the step before it each with its track.
    """

    def step(before: pa.Table | None, live: dict[int, int], now: pa.Table) -> dict[int, int]:
        """{node: track} of the detections of `now` that continue one."""
        going: dict[int, int] = {}
        for kind in set(before["type"].to_pylist()) if before is not None else ():
            last, lon, lat = (before.filter(pc.equal(before["type"], kind))[c].to_pylist() for c in ("node", "lon", "lat"))
            free = Places(*(now.filter(pc.equal(now["type"], kind))[c].to_pylist() for c in ("node", "lon", "lat")))
            points = _points(np.array(lon), np.array(lat))
            for track, i in sorted((live.get(n, n), i) for i, n in enumerate(last)):
                node = free.take_nearest(lon[i], lat[i], points[i], reach)
                if node is not None:
                    going[node] = track
        return going

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        live: dict[int, int] = {}  # the last node of each track that has gone on: its first
        before: pa.Table | None = None
        held: list[pa.RecordBatch] = []
        at = last = None  # the steps of `held` and `before`

        def done() -> pa.RecordBatch:
            nonlocal live, before, last
            now = pa.Table.from_batches(held)
            live = step(before if last is not None and at == last + 1 else None, live, now)
            before, last = now, at
            return pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in (live.keys(), live.values())], names=["node", "track"])

        for batch in batches:
            steps = batch["step"].to_numpy()
            bounds = np.concatenate([[0], np.flatnonzero(np.diff(steps)) + 1, [len(steps)]])
            out = []
            for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if x == y:
                    continue
                if held and int(steps[x]) != at:
                    out.append(done())
                    held.clear()
                at = int(steps[x])
                held.append(batch.slice(x, y - x))
            if out:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
        if held:
            yield done()

    return work


def resolve(found: DataFrame, dt: float = 1.0, prop_speed: float = PROP_SPEED) -> DataFrame:
    """(`node`, `track`): the first node of the track, for each detection that continues one."""
    placed = found.select("step", "node", "type", "lon", "lat").dropna().where(~F.isnan("lon") & ~F.isnan("lat"))
    parts = cut_lineage(segments(steps_in_reach(placed, dt, prop_speed)))
    # The step before a segment belongs to no other: it would lie in the segment itself.
    first = parts.groupBy("segment").agg((F.min("step") - 1).alias("step")).select("step", "segment")
    ordered = placed.join(parts.unionByName(first), "step").repartition("segment").sortWithinPartitions("segment", "step")
    return ordered.drop("segment").mapInArrow(_follow(prop_speed * dt), "node bigint, track bigint")


def track(found: DataFrame, dt: float = 1.0, prop_speed: float = PROP_SPEED) -> DataFrame:
    """Every detection with its track.

    `track_id` numbers tracks in the order they began and `seq` the points of a track.
    `exist_at_start` marks tracks that began at the first step.
    """
    found = cut_lineage(found)
    tracks = cut_lineage(resolve(found, dt, prop_speed))
    followed = found.join(tracks, "node", "left").withColumn("track", F.coalesce("track", "node"))
    first_step = found.agg(F.min("step")).scalar()
    begins = with_month(followed.where(F.col("track") == F.col("node")).select("track", "time", F.lit(1).alias("_one")))
    numbers = running_total(begins, "_one", "_number", ["track"]).select("track", (F.col("_number") - 1).alias("track_id"))
    start = step_of(F.col("track"))
    return followed.join(numbers, "track").select(
        "track_id",
        (F.col("step") - start).alias("seq"),
        *found.columns,
        (start == first_step).alias("exist_at_start"),
    )


def track_summary(points: DataFrame) -> DataFrame:
    """Points, length and end-to-end distance of each track (`track_id`, `seq`, `lon`, `lat`).

    A point meets the one before by (track, seq), so even a track of enormous length is
    spread over tasks.
    """
    before = points.select(
        "track_id", (F.col("seq") + 1).alias("seq"), F.col("lon").alias("_lon"), F.col("lat").alias("_lat")
    )
    legs = points.select("track_id", "seq", "lon", "lat").join(before, ["track_id", "seq"], "left")
    leg = distance_km(F.col("_lon"), F.col("_lat"), F.col("lon"), F.col("lat"))
    totals = legs.groupBy("track_id").agg(
        F.count(F.lit(1)).alias("points"),
        F.coalesce(F.sum(leg), F.lit(0.0)).alias("length_km"),
        *[F.min_by(c, "seq").alias(f"_{c}0") for c in ("lon", "lat")],
        *[F.max_by(c, "seq").alias(f"_{c}1") for c in ("lon", "lat")],
    )
    straight = distance_km(F.col("_lon0"), F.col("_lat0"), F.col("_lon1"), F.col("_lat1"))
    return totals.select("track_id", "points", "length_km", straight.alias("straight_km"))


def lasting_tracks(
    summary: DataFrame,
    dt: float = 1.0,
    d_tot_min: float = D_TOT_MIN,
    d_ratio: float = D_RATIO,
    dur_min: float = DUR_MIN,
) -> DataFrame:
    """Tracks that last longer than `dur_min`, are at least `d_tot_min` long and straight enough.

    A track of length zero has no ratio and is dropped.
    """
    return summary.where(
        (F.col("points") > F.lit(dur_min / dt))
        & (F.col("length_km") >= F.lit(d_tot_min))
        & (F.try_divide("straight_km", "length_km") >= F.lit(d_ratio))
    )


def strip(points: DataFrame, **limits: float) -> DataFrame:
    """Points of the tracks that `lasting_tracks` keeps."""
    points = cut_lineage(points)
    kept = lasting_tracks(track_summary(points), **limits).select("track_id")
    return points.join(kept, "track_id", "left_semi")
