"""Storms of frames, found in one flood of their cells in order of value.

Raising the level adds cells, and a cell joins the regions of its neighbours; each of a frame's
edges is looked at once, at the level where the second of its cells comes in. That gives all
regions of all levels. What a found storm takes out only concerns its own region:
of its cells the ring is left, and the ring alone is flooded anew for the levels still to come. All
frames of a batch are flooded side by side in flat arrays.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from gridgale.functions.geo import KM_PER_DEG_LAT, RADIUS_EXTENT, RADIUS_TRACKS
from gridgale.grid import GridSpec

BATCH_CELLS = 1 << 19  # cells flooded together; a larger frame is flooded alone


def rings_apart_km(iy: np.ndarray, ix: np.ndarray, spec: GridSpec) -> float:
    """The greatest distance between two cells of a ring.

    On two parallels the distance grows with the difference in longitude up to half a circle. So on
    narrower grids the ends of each row are enough; on wider ones a cell meets, in each row, the cells
    on both sides of the meridian opposite to it.
    """
    rows, at = np.unique(iy, return_inverse=True)
    phi = np.radians(spec.north - spec.res_lat * rows)
    sin, cos = np.sin(phi), np.cos(phi)
    if (spec.nx - 1) * spec.res_lon <= 180.0:
        low, high = np.full(len(rows), spec.nx), np.full(len(rows), -1)
        np.minimum.at(low, at, ix)
        np.maximum.at(high, at, ix)
        apart = spec.res_lon * np.maximum(high[:, None] - low[None, :], high[None, :] - low[:, None])
        least = (sin[:, None] * sin + np.cos(np.radians(apart)) * cos[:, None] * cos).min()
    else:
        least = 1.0
        order = np.lexsort((ix, at))
        bounds = np.searchsorted(at[order], np.arange(len(rows) + 1))
        turn = 360.0 / spec.res_lon
        for r in range(len(rows)):
            row = ix[order[bounds[r]:bounds[r + 1]]]
            place = np.searchsorted(row, (ix + turn / 2) % turn)
            for near in (row[place % len(row)], row[place - 1]):
                apart = np.radians((ix - near) * spec.res_lon)
                least = min(least, float((sin[at] * sin[r] + np.cos(apart) * cos[at] * cos[r]).min()))
    return RADIUS_EXTENT * math.acos(max(-1.0, min(1.0, float(least))))


def area_km2(cells: np.ndarray, latitude: np.ndarray, spec: GridSpec) -> np.ndarray:
    degree = math.pi / 180.0 * RADIUS_TRACKS * np.cos(np.radians(latitude))
    return cells * (spec.res_lat * spec.res_lon) * KM_PER_DEG_LAT * degree


class Flood:
    """The cells of several frames, flat, and the region each belongs to while the level rises.

    `rank` is the first of the rising levels that a cell lies below. A region's label is its smallest cell. On a
    grid `around` the globe the last column has the first one for a neighbour.
    """

    def __init__(self, values: np.ndarray, levels: np.ndarray, spec: GridSpec, around: bool = False):
        self.spec, self.values, self.around = spec, values, around
        self.rank = np.searchsorted(levels, values, side="right").astype(np.int32)
        self.size = len(values)
        cell = np.arange(self.size) % spec.cells
        self.iy, self.ix = cell // spec.nx, cell % spec.nx
        self.label = np.arange(self.size)
        self.by_rank = np.argsort(self.rank, kind="stable")
        self.ends = np.searchsorted(self.rank[self.by_rank], np.arange(len(levels)), side="right")
        self.edges = self._edges(np.arange(self.size), len(levels))

    def _edges(self, cells: np.ndarray, ranks: int) -> list[np.ndarray]:
        """For each rank below `ranks`, the pairs of neighbours among `cells` that it completes."""
        among = np.zeros(self.size + self.spec.nx, bool)
        among[cells] = True
        east = cells[(self.ix[cells] < self.spec.nx - 1) & among[cells + 1]]
        south = cells[(self.iy[cells] < self.spec.ny - 1) & among[cells + self.spec.nx]]
        seam = cells[(self.ix[cells] == self.spec.nx - 1) & among[cells - self.spec.nx + 1]] if self.around else cells[:0]
        a, b = np.concatenate([east, south, seam]), np.concatenate([east + 1, south + self.spec.nx, seam - self.spec.nx + 1])
        rank = np.maximum(self.rank[a], self.rank[b])
        order = np.argsort(rank, kind="stable")
        cuts = np.searchsorted(rank[order], np.arange(ranks + 1))
        pairs = np.stack([a, b])[:, order]
        return [pairs[:, x:y] for x, y in zip(cuts[:-1], cuts[1:])]

    def join(self, pairs: np.ndarray, cells: np.ndarray) -> None:
        """Regions that meet in `pairs` become one; `cells` get their labels."""
        label = self.label
        a, b = label[pairs[0]], label[pairs[1]]
        while True:
            a, b = label[a], label[b]
            apart = a != b
            a, b = a[apart], b[apart]
            if not len(a):
                break
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label[cells]]
            if np.array_equal(up, label[cells]):
                break
            label[cells] = up

    def below(self, k: int) -> np.ndarray:
        """The cells below level `k`, taken out or not."""
        return self.by_rank[:self.ends[k]]

    def interior(self, cells: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Whether all four neighbours of the masked cells are masked too."""
        nx, ny = self.spec.nx, self.spec.ny
        iy, ix = self.iy[cells], self.ix[cells]
        inner = (iy > 0) & (iy < ny - 1)
        if not self.around:
            inner &= (ix > 0) & (ix < nx - 1)
        some, x = cells[inner], ix[inner]
        west, east = np.where(x > 0, some - 1, some + nx - 1), np.where(x < nx - 1, some + 1, some - nx + 1)
        inner[inner] = mask[west] & mask[east] & mask[some - nx] & mask[some + nx]
        return inner


def lowest_cells(flood: Flood, cells: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each frame, the first of the lowest of some cells; the number of all cells where it has none."""
    frame = cells // flood.spec.cells
    low = np.full(flood.size // flood.spec.cells, np.inf)
    np.minimum.at(low, frame, values[cells])
    at = cells[values[cells] == low[frame]]
    first = np.full(len(low), flood.size)
    np.minimum.at(first, at // flood.spec.cells, at)
    return first


class Regions:
    """Regions of some cells that passed the tests so far: cells with their region, and figures by region.

    Cheap tests come first, and only regions that passed them are measured further.
    """

    def __init__(self, flood: Flood, cells: np.ndarray, labels: np.ndarray):
        self.flood, self.cells = flood, cells
        mask = np.zeros(flood.size, bool)
        mask[cells] = True
        self.inside = flood.interior(cells, mask)
        self.roots = cells[labels == cells]
        number = np.zeros(flood.size, np.int64)
        number[self.roots] = np.arange(len(self.roots))
        self.of = number[labels]
        self.figures: dict[str, np.ndarray] = {
            "n_cells": self.count(), "n_interior": np.bincount(self.of[self.inside], minlength=len(self.roots)),
        }

    def __len__(self) -> int:
        return len(self.roots)

    def __getitem__(self, name: str) -> np.ndarray:
        return self.figures[name]

    def count(self) -> np.ndarray:
        return np.bincount(self.of, minlength=len(self))

    def least(self, values: np.ndarray, where: np.ndarray | slice = slice(None)) -> np.ndarray:
        out = np.full(len(self), np.inf)
        np.minimum.at(out, self.of[where], values[self.cells[where]])
        return out

    def mean(self, values: np.ndarray, where: np.ndarray) -> np.ndarray:
        of = self.of[where]
        return np.bincount(of, values[self.cells[where]], len(self)) / np.bincount(of, minlength=len(self))

    def keep(self, passed: np.ndarray) -> None:
        new, stay = np.cumsum(passed) - 1, passed[self.of]
        self.cells, self.inside, self.of = self.cells[stay], self.inside[stay], new[self.of[stay]]
        self.roots = self.roots[passed]
        self.figures = {n: f[passed] for n, f in self.figures.items()}

    def accept(self, params) -> None:
        """Only the storms: interior, size, depth, and then the extent of those that are left."""
        values, spec = self.flood.values, self.flood.spec
        size = self["n_cells"]
        self.keep((self["n_interior"] > 0) & (size >= params.npix_min) & (size <= params.npix_max))
        f = self.figures
        f["low"], f["ring_low"] = self.least(values, self.inside), self.least(values, ~self.inside)
        f["ring_mean"] = self.mean(values, ~self.inside)
        f["amp_rel"], f["internal_extremum"] = f["ring_mean"] - f["low"], f["low"] < f["ring_low"]
        deep = f["amp_rel"] >= params.rel_amp_thresh
        self.keep(deep & f["internal_extremum"] if params.require_internal_extremum else deep)
        rings = self.of[~self.inside]
        order = np.argsort(rings, kind="stable")
        ring = self.cells[~self.inside][order]
        parts = np.split(ring, np.searchsorted(rings[order], np.arange(1, len(self)))) if len(self) else []
        self.figures["extent_km"] = np.array([rings_apart_km(self.flood.iy[r], self.flood.ix[r], spec) for r in parts], float)
        latitude = spec.north - spec.res_lat * self.flood.iy
        self.figures["interior_lat"] = self.mean(latitude, self.inside)
        limit = params.d_thresh
        if limit < 1:
            area = area_km2(self["n_cells"], self["interior_lat"], spec)
            limit = 2.0 * np.sqrt(area / (math.pi * math.sqrt(1.0 - limit * limit)))
        self.keep(self["extent_km"] < limit)

    def place(self, params, frame_low: np.ndarray, around: bool = False) -> None:
        """Centres and areas of the storms. `frame_low` has each frame's lowest cell."""
        flood, spec = self.flood, self.flood.spec
        ix = flood.ix
        if params.center == "center_of_mass":
            v = flood.values[self.cells]
            mass = np.bincount(self.of, v, len(self))
            x = ix[self.cells]
            if around:  # from the region's own first cell, half a circle to both sides
                first = ix[self.roots][self.of]
                x = first + (x - first + spec.nx // 2) % spec.nx - spec.nx // 2
            y = np.bincount(self.of, v * flood.iy[self.cells], len(self)) / mass
            x = np.bincount(self.of, v * x, len(self)) / mass % (spec.nx if around else np.inf)
        else:
            at = frame_low[self.roots // spec.cells]
            if params.center == "region_min":
                lowest = flood.values[self.cells] == self.least(flood.values)[self.of]
                at = np.full(len(self), flood.size)
                np.minimum.at(at, self.of[lowest], self.cells[lowest])
            y, x = flood.iy[at], ix[at]
        f = self.figures
        f["lat"], f["lon"] = spec.north - spec.res_lat * y, spec.west + spec.res_lon * x
        f["area_km2"] = area_km2(f["n_cells"], f["lat"], spec)

    def interiors(self) -> tuple[np.ndarray, np.ndarray]:
        """The interior cells storm after storm, and where each storm's begin and end."""
        of = self.of[self.inside]
        order = np.argsort(of, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(self)))])
        return self.cells[self.inside][order], ends


def _storms(flood: Flood, cells: np.ndarray, labels: np.ndarray, params) -> Regions:
    frame_low = lowest_cells(flood, cells, flood.values)
    found = Regions(flood, cells, labels)
    found.accept(params)
    found.place(params, frame_low)
    return found


def search_down(flood: Flood, ranks: int, params) -> Iterator[tuple[int, Regions]]:
    """From the highest level down: the regions of all levels are known before, but where storms were found."""
    regions = np.full((ranks, flood.size), -1, np.int32)
    for k in range(ranks):
        flood.join(flood.edges[k], flood.below(k))
        regions[k, flood.below(k)] = flood.label[flood.below(k)]
    for k in range(ranks - 1, -1, -1):
        cells = np.flatnonzero(regions[k] >= 0)
        storms = _storms(flood, cells, regions[k, cells].astype(np.int64), params)
        if not len(storms):
            continue
        yield k, storms
        regions[:k, storms.cells] = -1
        ring = storms.cells[~storms.inside]
        flood.label[ring] = ring
        for j, pairs in enumerate(flood._edges(ring, k)):
            wet = ring[flood.rank[ring] <= j]
            flood.join(pairs, wet)
            regions[j, wet] = flood.label[wet]


def search_up(flood: Flood, ranks: int, params) -> Iterator[tuple[int, Regions]]:
    """From the lowest level up: what is found is taken out before the level rises."""
    alive = np.ones(flood.size, bool)
    for k in range(ranks):
        pairs, wet = flood.edges[k], flood.below(k)
        wet = np.sort(wet[alive[wet]])
        flood.join(pairs[:, alive[pairs].all(axis=0)], wet)
        storms = _storms(flood, wet, flood.label[wet], params)
        if not len(storms):
            continue
        yield k, storms
        alive[storms.cells[storms.inside]] = False
        ring = storms.cells[~storms.inside]
        flood.label[ring] = ring
        for pairs in flood._edges(ring, k + 1):
            flood.join(pairs, ring)


FOUND = (
    "time timestamp_ntz, label int, level double, idx int, n_cells bigint, lon double, lat double, amp_abs double,"
    " area_km2 double, extent_km double, interior_cells array<int>"
)


KINDS = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}


def _as_rows(columns: dict, schema: str) -> pa.RecordBatch:
    fields = [c.split() for c in schema.split(", ")]
    arrays = [columns[n] if isinstance(columns[n], pa.Array) else pa.array(columns[n], KINDS[k]) for n, k in fields]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])


def dense(batch: pa.RecordBatch, name: str, spec: GridSpec) -> np.ndarray:
    """A value of all frames' cells, frame after frame; NaN where there is none."""
    size = batch["cells"].value_lengths().to_numpy()
    out = np.full(len(batch) * spec.cells, np.nan)
    at = batch["cells"].flatten().to_numpy() + np.repeat(np.arange(len(batch)) * spec.cells, size)
    out[at] = batch[name].flatten().to_numpy(zero_copy_only=False)
    return out


def in_turn(work, spec: GridSpec):
    """For `mapInArrow`: `work` over pieces of batches that are flooded together."""
    together = max(1, BATCH_CELLS // spec.cells)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), together):
                yield from work(batch.slice(begin, together))

    return pieces


def level_search(spec: GridSpec, params, levels: list[float], topdown: bool):
    """For `mapInArrow` over frames (`time`, `cells`, `values`): the storms of all levels, as `FOUND`."""
    rising = np.array(sorted(levels), float)

    def found(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        flood = Flood(dense(batch, "values", spec), rising, spec)
        next_idx = np.zeros(len(batch), np.int64)
        for k, storms in (search_down if topdown else search_up)(flood, len(rising), params):
            frame = storms.roots // spec.cells
            cells, ends = storms.interiors()
            columns = storms.figures | {
                "time": batch["time"].take(pa.array(frame)), "label": storms.roots % spec.cells,
                "level": np.full(len(storms), rising[k]), "amp_abs": storms["low"],
                # Storms of a level come in label order, frame after frame.
                "idx": next_idx[frame] + np.arange(len(frame)) - np.searchsorted(frame, frame),
                "interior_cells": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(cells % spec.cells, pa.int32())),
            }
            np.add.at(next_idx, frame, 1)
            yield _as_rows(columns, FOUND)

    return in_turn(found, spec)


STORMS = (
    "time timestamp_ntz, label int, n_cells bigint, n_interior bigint, amp_abs double, ring_extremum double, ring_mean double,"
    " amp_rel double, internal_extremum boolean, extent_km double, interior_lat double, lat double, lon double, area_km2 double,"
    " max_wind double, interior_cells array<int>, missing array<int>"
)
HOURS = (
    "time timestamp_ntz, lon_storm double, lat_storm double, amp_storm double, max_wind_speed double, area_storm double,"
    " _interiors array<array<int>>, missing array<int>"
)


def smoothed(values: np.ndarray, spec: GridSpec, along: list[float], across: list[float], around: bool = False) -> np.ndarray:
    """Frames under separable weights, mirrored at the borders; what is missing counts as the mean and is missing again."""
    stack = values.reshape(-1, spec.ny, spec.nx)
    gaps = np.isnan(stack)
    known = np.maximum((~gaps).sum(axis=(1, 2)), 1)
    mean = np.where(gaps, 0.0, stack).sum(axis=(1, 2)) / known
    work = np.where(gaps, mean[:, None, None], stack)
    for axis, kernel in ((2, along), (1, across)):
        reach, size = len(kernel) // 2, work.shape[axis]
        if reach:
            width = [(reach, reach) if a == axis else (0, 0) for a in range(3)]
            padded = np.pad(work, width, mode="wrap" if around and axis == 2 else "symmetric")
            taps = (np.take(padded, range(k, k + size), axis=axis) * w for k, w in enumerate(kernel))
            work = sum(taps)
    return np.where(gaps, np.nan, work).ravel()


def storm_search(spec: GridSpec, params, along: list[float], across: list[float], hourly: bool):
    """For `mapInArrow` over frames (`time`, `cells`, `msl`, `wind`): their storms as `STORMS`, or, `hourly`, a row
    for each frame with its first storm and the interiors of all, as `HOURS`; and the cells without pressure."""
    sign = params.sign
    level = np.array([sign * params.level])

    def found(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        values, wind = dense(batch, "msl", spec), dense(batch, "wind", spec)
        values = smoothed(values, spec, along, across, params.seam)
        gaps = np.flatnonzero(np.isnan(values))
        missing_wind = np.full(len(batch), -np.inf)
        np.fmax.at(missing_wind, gaps // spec.cells, wind[gaps])
        ends = np.searchsorted(gaps, np.arange(len(batch) + 1) * spec.cells)
        missing = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(gaps % spec.cells, pa.int32()))

        flood = Flood(sign * values, level, spec, params.seam)
        wet = np.sort(flood.below(0))
        flood.join(flood.edges[0], wet)
        storms = Regions(flood, wet, flood.label[wet])
        storms.accept(params)
        storms.place(params, lowest_cells(flood, np.flatnonzero(~np.isnan(values)), values), params.seam)
        frame, f = storms.roots // spec.cells, storms.figures
        inner, bounds = storms.interiors()
        interiors = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(inner % spec.cells, pa.int32()))
        strongest = np.zeros(len(storms))
        np.fmax.at(strongest, storms.of[storms.inside], wind[storms.cells[storms.inside]])
        f["max_wind"] = np.maximum(strongest, missing_wind[frame])
        f["amp_abs"], f["ring_extremum"], f["ring_mean"] = sign * f["low"], sign * f["ring_low"], sign * f["ring_mean"]
        if not hourly:
            rows = {"time": batch["time"].take(pa.array(frame)), "label": storms.roots % spec.cells, "interior_cells": interiors}
            yield _as_rows(f | rows | {"missing": missing.take(pa.array(frame))}, STORMS)
            return
        first = np.searchsorted(frame, np.arange(len(batch)))
        bounds = np.append(first, len(frame))
        quiet = bounds[1:] == bounds[:-1]
        at = pa.array(np.where(quiet, 0, first), mask=quiet)
        names = {"lon_storm": "lon", "lat_storm": "lat", "amp_storm": "amp_abs", "max_wind_speed": "max_wind", "area_storm": "area_km2"}
        columns = {n: pa.array(f[c], pa.float64()).take(at) for n, c in names.items()}
        stacked = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), interiors)
        yield _as_rows(columns | {"time": batch["time"], "_interiors": stacked, "missing": missing}, HOURS)

    return in_turn(found, spec)
