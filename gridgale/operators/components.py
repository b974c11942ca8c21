"""Connected components of cells inside a tile, and of tiles across their borders."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridgale.grid import GridSpec
from gridgale.session import cut_lineage


def tile_labels(nx: int):
    """A function that labels sorted raster positions; one array per tile.

    Two cells are in one region when they share a side. The label of a region is its
    smallest raster position. All tiles of an Arrow batch are labelled together.
    """

    @F.pandas_udf("array<int>")
    def label(tiles: pd.Series) -> pd.Series:
        sizes = tiles.map(len).to_numpy()
        if sizes.sum() == 0:
            return pd.Series([[] for _ in sizes])
        cells = np.concatenate(tiles.to_list()).astype(np.int64)
        stride = cells.max() + nx + 1
        place = np.repeat(np.arange(len(sizes)), sizes) * stride + cells

        def links(step, allowed):
            target = np.minimum(np.searchsorted(place, place + step), len(place) - 1)
            hit = allowed & (place[target] == place + step)
            return np.flatnonzero(hit), target[hit]

        east, south = links(1, cells % nx < nx - 1), links(nx, np.ones(len(cells), bool))
        a, b = np.concatenate([east[0], south[0]]), np.concatenate([east[1], south[1]])
        root = np.arange(len(place))
        while True:
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, root[a], low)
            np.minimum.at(new, root[b], low)
            while not np.array_equal(new, new[new]):
                new = new[new]
            if np.array_equal(new, root):
                break
            root = new
        return pd.Series(np.split(cells[root].astype(np.int32), np.cumsum(sizes)[:-1]))

    return label


def components(edges: DataFrame, keys: list[str]) -> DataFrame:
    """(`keys`, `node`, `root`) for undirected edges (`keys`, `a`, `b`): the smallest node
    that each node is connected to.

    Two steps in turn, until nothing changes. In the first, every node offers its smallest
    neighbour to its larger neighbours, in the second to its smaller ones; each edge is
    replaced by one to that neighbour, so connections stay and trees become stars in a
    logarithmic number of rounds, whichever way their numbers run. Each round is
    written out. Nodes without edges do not appear; a node's edge to itself names it.
    """
    a, b = F.col("a"), F.col("b")
    nodes = cut_lineage(edges.select(*keys, a.alias("node")).unionByName(edges.select(*keys, b.alias("node"))).distinct())
    state = cut_lineage(
        edges.where(a != b).select(*keys, F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    )
    mark = None
    while True:
        both = state.unionByName(state.select(*keys, b.alias("a"), a.alias("b")))
        lowest = both.groupBy(*keys, "a").agg(F.least(F.min("b"), a).alias("m"))
        # Larger neighbours go to the smallest neighbour.
        large = both.join(lowest, [*keys, "a"]).where(b > a).select(*keys, b.alias("a"), F.col("m").alias("b"))
        large = cut_lineage(large.distinct())
        # Smaller neighbours, and the node itself, go to the smallest.
        least = large.groupBy(*keys, "a").agg(F.min("b").alias("m"))
        small = large.join(least, [*keys, "a"]).where(b != F.col("m")).select(*keys, b.alias("a"), F.col("m").alias("b"))
        state = cut_lineage(small.unionByName(least.select(*keys, "a", F.col("m").alias("b"))).distinct())
        seen = state.agg(
            F.count("*"), F.sum(F.xxhash64(*keys, "a", "b").cast("decimal(38,0)")),
        ).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    roots = state.select(*keys, a.alias("node"), b.alias("root"))
    return nodes.join(roots, [*keys, "node"], "left").withColumn("root", F.coalesce("root", "node"))


def label_cells(cells: DataFrame, spec: GridSpec, frame_values: list[str] = ()) -> DataFrame:
    """Add `label` to cells (`time`, `iy`, `ix`, `cell`, ...).

    `frame_values` are columns equal within a frame. Only raster positions go to
    Python, in arrays no longer than a tile has cells.
    """
    tile = [] if spec.one_tile else [
        F.floor(F.col("iy") / spec.tile).alias("_ty"),
        F.floor(F.col("ix") / spec.tile).alias("_tx"),
    ]
    carried = ["cell"] + [c for c in cells.columns if c not in ("time", "cell", *frame_values)]
    grouped = cells.groupBy("time", *tile).agg(
        F.sort_array(F.collect_list(F.struct(*carried))).alias("_c"),
        *[F.first(v).alias(v) for v in frame_values],
    )
    labelled = grouped.withColumn("_l", tile_labels(spec.nx)(F.transform("_c", lambda c: c["cell"])))
    pairs = labelled.select(
        "time", *frame_values, F.explode(F.arrays_zip("_c", "_l")).alias("_p")
    )
    flat = pairs.select(
        "time", *frame_values, *[F.col("_p._c")[c].alias(c) for c in carried], F.col("_p._l").alias("label")
    )
    if spec.one_tile:
        return flat
    return join_tiles(flat, spec)


def join_tiles(flat: DataFrame, spec: GridSpec) -> DataFrame:
    """Give regions that meet at tile borders their common smallest label."""
    flat = cut_lineage(flat)
    side = flat.select("time", "iy", "ix", F.col("label").alias("a"))

    def meet(dy: int, dx: int, at_border: Column) -> DataFrame:
        beyond = flat.select(
            "time", (F.col("iy") - dy).alias("iy"), (F.col("ix") - dx).alias("ix"), F.col("label").alias("b")
        )
        return side.where(at_border).join(beyond, ["time", "iy", "ix"]).select("time", "a", "b")

    last = spec.tile - 1
    edges = meet(0, 1, F.col("ix") % spec.tile == last).unionByName(
        meet(1, 0, F.col("iy") % spec.tile == last)
    )
    roots = components(edges.distinct(), ["time"]).select("time", F.col("node").alias("label"), "root")
    return (
        flat.join(roots, ["time", "label"], "left")
        .withColumn("label", F.coalesce("root", "label"))
        .drop("root")
    )
