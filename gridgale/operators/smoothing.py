"""Gaussian smoothing of frames, along the grid rows and then across them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridgale.grid import GridSpec

# Part of the cut-off wavelength taken as sigma, and the kernel's reach in sigmas.
SIGMA_PART = 5.0
TRUNCATE = 4.0


def gaussian_kernel(sigma: float) -> list[float]:
    """Weights from -reach to +reach, summing to one."""
    if sigma <= 0:
        return [1.0]
    reach = int(TRUNCATE * sigma + 0.5)
    raw = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-reach, reach + 1)]
    return [w / sum(raw) for w in raw]


def reflect(index: int, size: int) -> int:
    """Index mirrored at the borders, the border cell itself being repeated."""
    index %= 2 * size
    return index if index < size else 2 * size - 1 - index


def border_weights(size: int, kernel: list[float]) -> dict[int, dict[int, float]]:
    """{position near a border: {offset: weight}}; mirrored taps add up where they fall."""
    reach = len(kernel) // 2
    weights: dict[int, dict[int, float]] = {}
    for p in range(size):
        if reach <= p < size - reach:
            continue
        taps = weights.setdefault(p, {})
        for k, w in enumerate(kernel):
            offset = reflect(p + k - reach, size) - p
            taps[offset] = taps.get(offset, 0.0) + w
    return weights


def _sum(terms: list[Column]) -> Column:
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def raster_window():
    """A frame from its north-west cell row by row. All passes use this one order, hence one sort."""
    return Window.partitionBy("time").orderBy("iy", "ix")


def smooth_axis(
    cells: DataFrame, value: str, out: str, axis: str, stride: int, size: int, kernel: list[float]
) -> DataFrame:
    """Weighted sum of a cell and its neighbours along `axis`.

    Frames are complete, so the neighbour `n` steps away lies `n * stride` rows away in
    raster order: one row along a grid row, `nx` rows across. Near a border only taps
    inside the grid have a weight.
    """
    reach = len(kernel) // 2
    if reach == 0:
        return cells.withColumn(out, F.col(value))
    borders = border_weights(size, kernel)
    offsets = sorted({o for taps in borders.values() for o in taps} | set(range(-reach, reach + 1)))
    near = {o: f"_n{i}" for i, o in enumerate(offsets)}
    shifted = cells.withColumns({name: F.lag(value, -o * stride).over(raster_window()) for o, name in near.items()})
    total = _sum([F.lit(w) * F.col(near[k - reach]) for k, w in enumerate(kernel)])
    for p, taps in borders.items():
        at_border = _sum([F.lit(w) * F.col(near[o]) for o, w in sorted(taps.items())])
        total = F.when(F.col(axis) == p, at_border).otherwise(total)
    return shifted.withColumn(out, total).drop(*near.values())


def fill_missing(cells: DataFrame, value: str, out: str) -> DataFrame:
    """Put the frame's mean where it has no value."""
    frame = raster_window().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return cells.withColumn(out, F.coalesce(F.col(value), F.avg(value).over(frame)))


def smooth(
    cells: DataFrame,
    spec: GridSpec,
    value: str,
    out: str,
    cut_lon: float = 1.0,
    cut_lat: float = 1.0,
) -> DataFrame:
    """Remove features shorter than the cut-off; missing cells are missing again afterwards."""
    along = gaussian_kernel(cut_lon / SIGMA_PART / spec.res_lon)
    across = gaussian_kernel(cut_lat / SIGMA_PART / spec.res_lat)
    filled = fill_missing(cells, value, "_filled")
    one = smooth_axis(filled, "_filled", "_along", "ix", 1, spec.nx, along).drop("_filled")
    two = smooth_axis(one, "_along", "_both", "iy", spec.nx, spec.ny, across)
    restored = two.withColumn(out, F.when(F.col(value).isNotNull(), F.col("_both")))
    return restored.drop("_along", "_both")
