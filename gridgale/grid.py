"""The regular latitude/longitude grid on which all observations lie."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GridSpec:
    """`ny` rows from `north` downwards and `nx` columns from `west` eastwards.

    A frame (all cells of one time) holds at most `ny * nx` distinct cells, so the
    grid bounds every group the storm operators build. `tile` is the side, in cells,
    of the squares in which regions are labelled before they are joined across
    square borders.
    """

    ny: int
    nx: int
    north: float
    west: float
    res_lat: float = 0.25
    res_lon: float = 0.25
    tile: int = 1024

    @property
    def cells(self) -> int:
        return self.ny * self.nx

    @property
    def one_tile(self) -> bool:
        return self.ny <= self.tile and self.nx <= self.tile

    def iy(self, latitude: Column) -> Column:
        return F.round((F.lit(float(self.north)) - latitude) / F.lit(self.res_lat)).cast("int")

    def ix(self, longitude: Column) -> Column:
        return F.round((longitude - F.lit(float(self.west))) / F.lit(self.res_lon)).cast("int")

    def latitude(self, iy: Column) -> Column:
        return F.lit(float(self.north)) - F.lit(self.res_lat) * iy

    def longitude(self, ix: Column) -> Column:
        return F.lit(float(self.west)) + F.lit(self.res_lon) * ix

    def raster(self, iy: Column, ix: Column) -> Column:
        """Position in row-major order, north-west cell first."""
        return (iy * F.lit(self.nx) + ix).cast("int")


# The default area, 65 x 41 cells of a quarter degree.
VIETNAM_GRID = GridSpec(ny=65, nx=41, north=24.0, west=102.0)
BBOX = {"south": 8.0, "north": 24.0, "west": 102.0, "east": 112.0}
