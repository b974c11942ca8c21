"""Grid frames: all cells of one time, as rows (`time`, `iy`, `ix`, values).

A frame has at most `ny * nx` cells, so whatever is grouped or windowed by time is
bounded by the grid, not by the table. Cells are shuffled by `time` once and the later
windows, which all start with `time`, stay in place.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridgale.grid import GridSpec


def _on_grid(df: DataFrame, spec: GridSpec, time_column: str, extra: Sequence[Column] = ()) -> DataFrame:
    return df.select(
        F.col(time_column).alias("time"),
        spec.iy(F.col("latitude")).alias("iy"),
        spec.ix(F.col("longitude")).alias("ix"),
        *extra,
    ).where(F.col("iy").between(0, spec.ny - 1) & F.col("ix").between(0, spec.nx - 1))


def to_cells(df: DataFrame, spec: GridSpec, values: dict[str, Column], time_column: str = "time") -> DataFrame:
    """The rows of `df` that lie on the grid, one for every cell of every frame.

    Rows are shuffled by time once, and all that follows stays there. Copies of a cell are
    folded to one of them, the one with the smallest known values in the order of
    `values`, row by row and not column by column; then a frame has at most the grid's
    cells, and the cells that it lacks are added with null values.
    """
    names = list(values)
    known = [F.when(~F.isnan(v), v).cast("double").alias(n) for n, v in values.items()]
    folded = _fold(df, spec, known, names, time_column)
    listed = folded.groupBy("time").agg(
        F.collect_list(F.when(F.col("cell").isNotNull(), F.struct("cell", *[F.col("_v")[n].alias(n) for n in names]))).alias("_have")
    )
    every = F.sequence(F.lit(0), F.lit(spec.cells - 1))
    lacking = F.transform(
        F.array_except(every, F.transform("_have", lambda c: c["cell"])),
        lambda c: F.struct(c.alias("cell"), *[F.lit(None).cast("double").alias(n) for n in names]),
    )
    whole = F.when(F.size("_have") == spec.cells, F.col("_have")).otherwise(F.concat("_have", lacking))
    cells = listed.select("time", F.explode(whole).alias("_c"))
    return cells.select(
        "time", F.floor(F.col("_c.cell") / F.lit(spec.nx)).cast("int").alias("iy"), (F.col("_c.cell") % F.lit(spec.nx)).alias("ix"),
        *[F.col("_c")[n].alias(n) for n in names],
    )


def frame_values(df: DataFrame, spec: GridSpec, values: dict[str, Column], time_column: str = "time") -> DataFrame:
    """(`time`, `cells`, and an array for each of `values`): one row a frame, with the raster positions it has.

    Rows are shuffled by time once. Copies of a cell fold to one whole row as in `to_cells`. A frame whose rows
    all lie off the grid has empty arrays.
    """
    names = list(values)
    known = [F.when(~F.isnan(v), v).cast("double").alias(n) for n, v in values.items()]
    folded = _fold(df, spec, known, names, time_column)
    cell = F.when(F.col("cell").isNotNull(), F.struct("cell", *[F.col("_v")[n].alias(n) for n in names]))
    listed = folded.groupBy("time").agg(F.collect_list(cell).alias("_c"))
    return listed.select("time", F.col("_c.cell").alias("cells"), *[F.col("_c")[n].alias(n) for n in names])


def _fold(df: DataFrame, spec: GridSpec, known: list[Column], names: list[str], time_column: str) -> DataFrame:
    """(`time`, `cell`, `_v`): each cell's row with the smallest known values; `cell` is null off the grid."""
    iy, ix = spec.iy(F.col("latitude")), spec.ix(F.col("longitude"))
    inside = iy.between(0, spec.ny - 1) & ix.between(0, spec.nx - 1)
    placed = df.select(F.col(time_column).alias("time"), F.when(inside, spec.raster(iy, ix)).cast("int").alias("cell"), *known)
    # Unknown values come after all known ones.
    ranks = [x.alias(n) for v in names for x, n in ((F.col(v).isNull(), f"_{v}"), (F.col(v), v))]
    return placed.repartition("time").groupBy("time", "cell").agg(F.min(F.struct(*ranks)).alias("_v"))


BITS = 64


def cell_bitmaps(df: DataFrame, spec: GridSpec, time_column: str = "time", known: Column | None = None) -> DataFrame:
    """(`time`, `iy`, `block`, `bits`, `rows`): the cells present (or `known`) as bits of longs.

    Distinct cells become an ordinary partial aggregation; what is shuffled is a long
    for every 64 cells, however often a cell is repeated.
    """
    spots = _on_grid(df, spec, time_column, [(F.lit(True) if known is None else known).alias("_known")])
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("ix") % BITS)
    return spots.groupBy("time", "iy", F.floor(F.col("ix") / BITS).cast("int").alias("block")).agg(
        F.coalesce(F.bit_or(F.when(F.col("_known"), bit)), F.lit(0).cast("long")).alias("bits"),
        F.count(F.lit(1)).alias("rows"),
    )


def completeness(df: DataFrame, spec: GridSpec, time_column: str = "time") -> DataFrame:
    """Rows and distinct cells of each frame.

    A frame is `complete` with all cells of the grid, and `regular` when there is also
    no cell twice.
    """
    counted = cell_bitmaps(df, spec, time_column).groupBy("time").agg(
        F.sum("rows").alias("rows"), F.sum(F.bit_count("bits")).cast("long").alias("cells")
    )
    whole = F.col("cells") == F.lit(spec.cells)
    return counted.withColumns({"complete": whole, "regular": whole & (F.col("rows") == F.col("cells"))})


def missing_cells(df: DataFrame, spec: GridSpec, value: str, time_column: str = "time") -> DataFrame:
    """(`time`, `iy`, `ix`) of the cells without a value, absent ones included.

    Read off the bitmaps of the known cells: frames without gaps end there.
    """
    blocks = -(-spec.nx // BITS)
    known = F.col(value).isNotNull() & ~F.isnan(value)
    number = F.col("iy") * F.lit(blocks) + F.col("block")
    frames = cell_bitmaps(df, spec, time_column, known).groupBy("time").agg(
        F.collect_list(F.struct(number.cast("int").alias("number"), "bits")).alias("_have"),
        F.sum(F.bit_count("bits")).alias("_known"),
    )
    every = F.sequence(F.lit(0), F.lit(spec.ny * blocks - 1))
    absent = F.array_except(every, F.transform("_have", lambda h: h["number"]))
    none = F.lit(0).cast("long")
    all_blocks = F.concat(
        "_have", F.transform(absent, lambda n: F.struct(n.alias("number"), none.alias("bits")))
    )
    holes = frames.where(F.col("_known") < F.lit(spec.cells)).select("time", F.explode(all_blocks).alias("_b"))
    cells = holes.select("time", "_b.number", "_b.bits", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("_j"))
    ix = (F.col("number") % blocks) * BITS + F.col("_j")
    unset = F.call_function("shiftright", F.col("bits"), F.col("_j")).bitwiseAND(F.lit(1).cast("long")) == 0
    return cells.where(unset & (ix < spec.nx)).select(
        "time", F.floor(F.col("number") / blocks).cast("int").alias("iy"), ix.cast("int").alias("ix")
    )


def whole_frames(cells: DataFrame, spec: GridSpec, value: str) -> DataFrame:
    """One row per time with the flattened frame, north-west cell first; for export."""
    raster = spec.raster(F.col("iy"), F.col("ix"))
    listed = cells.groupBy("time").agg(
        F.sort_array(F.collect_list(F.struct(raster.alias("cell"), F.col(value).alias("v")))).alias("_f")
    )
    return listed.select("time", F.transform("_f", lambda c: c["v"]).alias("frame"))


def point_series(df: DataFrame, spec: GridSpec, latitude: float, longitude: float, value: str) -> DataFrame:
    """The values of the cell that covers a point, in time order."""
    at = (spec.iy(F.col("latitude")) == spec.iy(F.lit(latitude))) & (
        spec.ix(F.col("longitude")) == spec.ix(F.lit(longitude))
    )
    near = F.col("latitude").between(latitude - spec.res_lat, latitude + spec.res_lat)
    return df.where(near & at).select("time", value).orderBy("time")


def _edges_of_globe(spec: GridSpec, degrees: float) -> tuple[int, int]:
    """The first column that is repeated in the west, and how many are repeated in the east."""
    longitudes = [spec.west + spec.res_lon * i for i in range(spec.nx)]
    first_east = min(i for i, lon in enumerate(longitudes) if lon >= 360.0 - degrees)
    return first_east, max(i for i, lon in enumerate(longitudes) if lon <= degrees)


def wrapped_spec(spec: GridSpec, degrees: float = 20.0) -> GridSpec:
    """The wider grid of `wrap_globe`."""
    first_east, last_west = _edges_of_globe(spec, degrees)
    return replace(spec, nx=2 * spec.nx - first_east + last_west, west=spec.west + spec.res_lon * first_east - 360.0)


def wrap_globe(cells: DataFrame, spec: GridSpec, degrees: float = 20.0) -> tuple[DataFrame, GridSpec]:
    """Repeat the eastern edge in the west and the western edge in the east, with all columns.

    Returns the cells and their wider grid. The column just at `degrees` in the west is
    left out, as the piece ends before it.
    """
    first_east, last_west = _edges_of_globe(spec, degrees)
    shift = spec.nx - first_east
    ix = F.col("ix")
    places = F.array_compact(
        F.array(
            ix + shift,
            F.when(ix >= first_east, ix - first_east),
            F.when(ix < last_west, ix + shift + spec.nx),
        )
    )
    others = [c for c in cells.columns if c != "ix"]
    return cells.select(*others, F.explode(places).alias("ix")).select(*cells.columns), wrapped_spec(spec, degrees)
