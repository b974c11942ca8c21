"""Near vectors by dual traversal of cover trees.

Vectors become points on the unit sphere, where a cosine is a distance. A tree's nodes are
nested: a node's points lie within its radius of its centre, its children's within half of
it, and a centre stays centre of one child. Two nodes are compared by their centres: with radii
between them and the threshold they cannot hold a link, with radii inside it all their points are
linked, and otherwise the larger node is opened. So a group of near copies is counted as a
whole, however many pairs it has, and no pair is lost.

A label with more points than a block holds is first divided, cell by cell: points go to the nearest of
a few of the cell's points. Pairs of cells are followed down these levels by the same
bounds, and the blocks left at their ends meet, each with the tree of its points.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridgale.llm.common import written
from gridgale.operators.components import components

COSINE = 0.93
BLOCK = 1024  # points of a block, about
FAN = 8  # cells that a larger cell is divided into
LEVELS = 12  # divisions; what is larger then is cut by hash
SLACK = 1e-7  # distances closer to a bound than this are not decided by it
POINT = 1e-9  # a node of a smaller radius is not divided
PAIRS = 1 << 15  # node pairs compared at once


def unit(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors in double precision, scaled by powers of two out of the way of overflow, and of length one."""
    x = raw.astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return x, x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


class CoverTree:
    """Points in the order of the tree; node `i` holds points `begin[i]` to `end[i]`, the first being its
    centre, and its children are nodes `child[i]` to `child_end[i]`."""

    FIELDS = {"begin": "<i4", "end": "<i4", "child": "<i4", "child_end": "<i4", "radius": "<f8"}

    def __init__(self, points: np.ndarray, weights: np.ndarray, ids: np.ndarray, **nodes: np.ndarray):
        self.x, self.u = unit(points)
        self.ids, self.weights = ids, weights
        self.before = np.concatenate([[0], np.cumsum(weights)])
        self.__dict__.update(nodes)

    def weight(self, node: np.ndarray) -> np.ndarray:
        return self.before[self.end[node]] - self.before[self.begin[node]]


def grow(raw: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The order of the points in their tree, and its nodes, level by level."""
    _, u = unit(raw)

    def away(centre: int, others: np.ndarray) -> np.ndarray:
        return np.sqrt(np.square(u[others] - u[centre]).sum(axis=1))

    order = np.arange(len(u))
    nodes = [(order, away(0, order), 0)]  # the points, centre first; how far they are from it; where they begin
    begin, end, child, child_end, radius = [], [], [], [], []
    for members, distance, at in nodes:  # grows while it is walked
        r = float(distance.max())
        begin.append(at)
        end.append(at + len(members))
        radius.append(r)
        child.append(len(nodes))
        if r <= POINT:
            order[at:at + len(members)] = members
        else:
            left, d, centre = members, distance, members[0]
            while True:
                near = d <= r / 2
                nodes.append((left[near], d[near], at))
                at += int(near.sum())
                left = left[~near]
                if not len(left):
                    break
                # A point that no child covers is the centre of the next one.
                centre = left[0]
                d = away(centre, left)
        child_end.append(len(nodes))
    arrays = {n: np.array(v, k) for (n, k), v in zip(CoverTree.FIELDS.items(), (begin, end, child, child_end, radius))}
    return order, arrays


class Links:
    """What the traversal of two trees found, for the points of both, one after another."""

    def __init__(self, a: CoverTree, b: CoverTree, cosine: float):
        self.a, self.b, self.cosine = a, b, cosine
        self.same = a is b
        self.shift = 0 if self.same else len(a.ids)
        size = len(a.ids) + (0 if self.same else len(b.ids))
        self.count, self.chain = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)
        self.edges: list[np.ndarray] = []
        self.walk()

    def whole(self, a: np.ndarray, b: np.ndarray) -> None:
        """All points of node `a` are linked with all of node `b`."""
        back = np.where(a == b, 0, self.a.weight(a)) if self.same else self.a.weight(a)
        for tree, node, weight, shift in ((self.a, a, self.b.weight(b), 0), (self.b, b, back, self.shift)):
            np.add.at(self.count, tree.begin[node] + shift, weight)
            np.add.at(self.count, tree.end[node] + shift, -weight)
            # The points of a node with a link outside it, or with each other, hang together.
            np.add.at(self.chain, tree.begin[node] + shift + 1, 1)
            np.add.at(self.chain, tree.end[node] + shift, -1)
        self.edges.append(np.stack([self.a.begin[a], self.b.begin[b] + self.shift]))

    def each(self, a: int, b: int) -> None:
        """Points of two nodes too near the threshold: their cosines decide."""
        rows = np.arange(self.a.begin[a], self.a.end[a])
        for j in range(self.b.begin[b], self.b.end[b]):
            y = self.b.x[j]
            x = self.a.x[rows[rows <= j] if self.same and a == b else rows]
            cosine = (x * y).sum(axis=1) / np.sqrt(np.square(x).sum(axis=1) * np.square(y).sum())
            hit = rows[:len(x)][cosine >= self.cosine]
            if self.same and a == b:
                hit = hit[hit < j]
                self.count[j] += self.a.weights[j]
                self.count[j + 1] -= self.a.weights[j]
            for i in hit.tolist():
                for place, w in ((i, self.b.weights[j]), (j + self.shift, self.a.weights[i])):
                    self.count[place] += w
                    self.count[place + 1] -= w
            if len(hit):
                self.edges.append(np.stack([hit, np.full(len(hit), j + self.shift)]))

    def walk(self) -> None:
        a, b, limit = self.a, self.b, math.sqrt(2.0 - 2.0 * self.cosine)
        waiting = [(np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while waiting:
            i, j = waiting.pop()
            if len(i) > PAIRS:
                waiting.append((i[PAIRS:], j[PAIRS:]))
                i, j = i[:PAIRS], j[:PAIRS]
            dot = np.einsum("ij,ij->i", a.u[a.begin[i]], b.u[b.begin[j]])
            d = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * dot))
            reach = a.radius[i] + b.radius[j]
            if self.same:
                d[i == j] = 0.0
            whole = d + reach <= limit - SLACK
            if whole.any():
                self.whole(i[whole], j[whole])
            open_ = ~whole & (d <= limit + reach + SLACK)
            i, j = i[open_], j[open_]
            ends_a, ends_b = a.child[i] == a.child_end[i], b.child[j] == b.child_end[j]
            for x, y in zip(i[ends_a & ends_b].tolist(), j[ends_a & ends_b].tolist()):
                self.each(x, y)
            rest = ~(ends_a & ends_b)
            i, j = i[rest], j[rest]
            if not len(i):
                continue
            alone = (i == j) & self.same
            left = ~ends_a[rest] & (ends_b[rest] | (a.radius[i] >= b.radius[j]))
            for chosen, first in ((left & ~alone, True), (~left & ~alone, False)):
                opened, kept, tree = (i, j, a) if first else (j, i, b)
                opened, kept = opened[chosen], kept[chosen]
                if len(opened):
                    n = tree.child_end[opened] - tree.child[opened]
                    children = np.repeat(tree.child[opened] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                    kept = np.repeat(kept, n)
                    waiting.append((children, kept) if first else (kept, children))
            for node in i[alone].tolist():
                # A node with itself: its children with themselves and with those after them.
                children = np.arange(a.child[node], a.child_end[node])
                x, y = np.triu_indices(len(children))
                waiting.append((children[x], children[y]))

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the points with links: id, weight of other points linked, and the id of their group's first."""
        ids = self.a.ids if self.same else np.concatenate([self.a.ids, self.b.ids])
        count = np.cumsum(self.count)[:-1]
        if self.same:
            count = count - self.a.weights
        chained = np.flatnonzero(np.cumsum(self.chain)[:-1] > 0)
        edges = np.concatenate([*self.edges, np.stack([chained - 1, chained])], axis=1).astype(np.int64)
        root = np.arange(len(ids))
        while True:
            low = np.minimum(root[edges[0]], root[edges[1]])
            new = root.copy()
            np.minimum.at(new, edges[0], low)
            np.minimum.at(new, edges[1], low)
            new = np.minimum(new, new[root])
            if np.array_equal(new, root):
                break
            root = new
        linked = np.flatnonzero(count > 0)
        return ids[linked], count[linked], ids[root[linked]]


TREE = "points binary, weights binary, ids binary, " + ", ".join(f"{c} binary" for c in ("begin", "end", "child", "child_end", "radius"))


def _vectors(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nearest of the pivots for each point, and how far it is."""
    for batch in batches:
        place, far = np.zeros(len(batch), np.int32), np.zeros(len(batch))
        dims = batch["dim"].to_numpy()
        width = batch["pivots"].value_lengths().to_numpy()
        for dim, pivots in set(zip(dims.tolist(), width.tolist())):
            rows = np.flatnonzero((dims == dim) & (width == pivots))
            at = pa.array(rows)
            _, u = unit(_vectors(batch["vec"].take(at), dim))
            _, p = unit(_vectors(batch["pivots"].take(at).flatten(), dim))
            d = np.sqrt(np.square(u[:, None, :] - p.reshape(len(rows), pivots, dim)).sum(axis=2))
            place[rows], far[rows] = d.argmin(axis=1), d.min(axis=1)
        columns = [batch[c] for c in batch.schema.names if c != "pivots"] + [pa.array(place), pa.array(far)]
        yield pa.RecordBatch.from_arrays(columns, names=[c for c in batch.schema.names if c != "pivots"] + ["place", "far"])


def _tree(table: pa.Table) -> pa.Table:
    """One row with the cover tree of a block's points."""
    dim = table["dim"][0].as_py()
    raw, ids = _vectors(table["vec"], dim), table["node"].to_numpy()
    start = np.argsort(ids)  # rows come in any order
    raw, ids, weights = raw[start], ids[start], table["copies"].to_numpy()[start]
    order, nodes = grow(raw)
    _, centre = unit(raw[order[:1]])
    columns = {c: table[c].slice(0, 1) for c in ("label", "dim", "cell", "block")}
    columns |= {"n": pa.array([len(ids)], pa.int64()), "reach": pa.array([float(nodes["radius"][0])])}
    columns["centre"] = pa.array([centre[0].tolist()], pa.list_(pa.float64()))
    parts = {"points": raw[order], "weights": weights[order].astype("<i8"), "ids": ids[order].astype("<i8"), **nodes}
    columns |= {c: pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for c, v in parts.items()}
    return pa.table(columns)


def _traverse(cosine: float, kind: str):
    """(`node`, `n`, `root`) from trees in the order of `a`: first its own, then those that meet it."""

    def tree(row: dict) -> CoverTree:
        nodes = {c: np.frombuffer(row[c], k) for c, k in CoverTree.FIELDS.items()}
        points = np.frombuffer(row["points"], kind).reshape(-1, row["dim"])
        return CoverTree(points, np.frombuffer(row["weights"], "<i8"), np.frombuffer(row["ids"], "<i8"), **nodes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            for k in range(len(batch)):
                row = {c: batch[c][k].as_py() for c in batch.schema.names}
                if row["other"] is None:
                    own = tree(row)
                    found = Links(own, own, cosine)
                else:
                    found = Links(own, tree(row), cosine)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found.rows()], names=["node", "n", "root"])

    return work


def _apart(a: Column, b: Column) -> Column:
    """The distance of two points of length one."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(F.lit(0.0), F.lit(2.0) - F.lit(2.0) * dot))


def _unit(vec: str) -> Column:
    """Of length one; the largest part is brought to one first."""
    most = F.array_max(F.transform(vec, lambda x: F.abs(x.cast("double"))))
    scaled = F.transform(vec, lambda x: x.cast("double") / most)
    norm = F.sqrt(F.aggregate(scaled, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(scaled, lambda x: x / norm)


GROUP = ["label", "dim"]


def _meet(pairs: DataFrame, parts: DataFrame, limit: float) -> DataFrame:
    """Pairs of the next level: (`label`, `dim`, `a`, `b`) with parts (`cell`, `part`, `centre`, `reach`) in place
    of cells, but for those too far apart. Cells without parts stay as they are."""
    def side(name: str) -> DataFrame:
        return parts.select(
            *GROUP, F.col("cell").alias(name), F.col("part").alias(f"part_{name}"), F.col("centre").alias(f"centre_{name}"),
            F.col("reach").alias(f"reach_{name}"),
        )

    opened = pairs.join(side("a"), [*GROUP, "a"], "left").join(side("b"), [*GROUP, "b"], "left")
    new_a, new_b = F.coalesce("part_a", "a"), F.coalesce("part_b", "b")
    far = _apart(F.col("centre_a"), F.col("centre_b")) > F.lit(limit + SLACK) + F.col("reach_a") + F.col("reach_b")
    once = (F.col("a") != F.col("b")) | (new_a <= new_b)
    return opened.where(once & ((new_a == new_b) | ~F.coalesce(far, F.lit(False)))).select(*GROUP, new_a.alias("a"), new_b.alias("b"))


def near_points(points: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(`node`, `n`, `root`) for the points (`node`, `label`, `dim`, `vec`, `copies`) with links: the copies of other
    points linked with it, summed over several rows, and a point it hangs together with."""
    limit = math.sqrt(2.0 - 2.0 * cosine)
    sizes = points.groupBy(*GROUP).agg(F.count("*").alias("size"))
    several = sizes.where(F.col("size") > 1).select(*GROUP)
    state = written(points.join(several, GROUP, "left_semi").withColumn("cell", F.lit("")), "tree-points")
    pairs = written(several.select(*GROUP, F.lit("").alias("a"), F.lit("").alias("b")), "tree-pairs")
    ended = []
    for level in range(LEVELS):
        sized = state.groupBy(*GROUP, "cell").agg(F.count("*").alias("size"))
        large = written(sized.where(F.col("size") > BLOCK).select(*GROUP, "cell"), "tree-large")
        if large.isEmpty():
            break
        ended.append(state.join(large, [*GROUP, "cell"], "left_anti"))
        inside = state.join(large, [*GROUP, "cell"], "left_semi")
        drawn = F.xxhash64(F.lit(level), "node")
        picked = inside.groupBy(*GROUP, "cell", F.pmod(drawn, F.lit(FAN)).alias("_p")).agg(F.min_by("vec", drawn).alias("vec"))
        pivots = written(picked.groupBy(*GROUP, "cell").agg(F.sort_array(F.collect_list("vec")).alias("pivots")), "tree-pivots")
        asked = inside.join(pivots, [*GROUP, "cell"])
        schema = T.StructType([f for f in asked.schema.fields if f.name != "pivots"]).add("place", T.IntegerType()).add("far", T.DoubleType())
        routed = written(asked.mapInArrow(_route, schema), "tree-routed")
        part = F.concat_ws("/", "cell", "place")
        reach = routed.groupBy(*GROUP, "cell", "place").agg(F.max("far").alias("reach"))
        centres = pivots.select(*GROUP, "cell", F.posexplode("pivots").alias("place", "vec"))
        parts = reach.join(centres, [*GROUP, "cell", "place"]).select(*GROUP, "cell", part.alias("part"), _unit("vec").alias("centre"), "reach")
        pairs = written(_meet(pairs, parts, limit), "tree-pairs")
        state = routed.withColumn("cell", part).drop("place", "far")
    for cells in ended:
        state = state.unionByName(cells)
    # A cell that is large still is cut by hash.
    sized = state.groupBy(*GROUP, "cell").agg(F.ceil(F.count("*") / (2 * BLOCK)).alias("cuts"))
    cut = F.when(F.col("cuts") > 1, F.concat_ws("#", "cell", F.pmod(F.xxhash64("node"), "cuts"))).otherwise(F.col("cell"))
    blocked = state.join(sized, [*GROUP, "cell"]).withColumn("block", cut)
    kinds = points.schema
    head = f"label {kinds['label'].dataType.simpleString()}, dim int, cell string, block string"
    trees = written(
        blocked.select(*GROUP, "cell", "block", "node", "vec", "copies").groupBy(*GROUP, "cell", "block")
        .applyInArrow(_tree, f"{head}, n bigint, reach double, centre array<double>, {TREE}"),
        "trees",
    )
    parts = trees.select(*GROUP, "cell", F.col("block").alias("part"), "centre", "reach")
    met = _meet(pairs, parts, limit).where("a <> b")
    tree = [c.split()[0] for c in TREE.split(", ")]
    others = met.join(trees.withColumnRenamed("block", "b"), [*GROUP, "b"]).select(*GROUP, "a", F.col("b").alias("other"), *tree)
    own = trees.select(*GROUP, F.col("block").alias("a"), F.lit(None).cast("string").alias("other"), *tree)
    streamed = own.unionByName(others).repartition(*GROUP, "a").sortWithinPartitions(*GROUP, "a", F.col("other").isNotNull())
    kind = "<f4" if kinds["vec"].dataType.elementType == T.FloatType() else "<f8"
    return written(streamed.mapInArrow(_traverse(cosine, kind), "node bigint, n bigint, root bigint"), "tree-links")


def near_vectors(
    vectors: DataFrame, carry: list[str] | None = None, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    cosine: float = COSINE,
) -> DataFrame:
    """`row` (the columns `carry`, by default all) with `n_links`, `component_id` and `kept`, one row a vector.

    Vectors are linked when their labels are equal and their cosine is at least `cosine`, in double
    precision. `n_links` counts the other rows linked with it, `component_id` is the smallest key reachable
    by links. A vector that is null, empty, zero or holds a null or something not finite, or
    whose label is null, is linked with nothing; vectors of unequal lengths are not linked. Rows with
    equal vectors are linked, and stand as one point in the trees, so copies are never paired. Rows
    that repeat a key count each. A null key is never a component's, unless all its keys are null; such a
    row is kept only then. An empty table gives no row.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in (carry or vectors.columns)]).alias("row")
    given = vectors.select(row, F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("vec"), F.col(f"`{label}`").alias("label"))
    if vectors.schema[vector].dataType.elementType != T.FloatType():
        given = given.withColumn("vec", F.col("vec").cast("array<double>"))
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("vec", lambda x: x != 0)
    fit = F.coalesce(F.col("label").isNotNull() & (F.size("vec") > 0) & sound, F.lit(False))
    hashes = [F.when(fit, F.xxhash64(F.lit(seed), "label", "vec")).alias(f"h{seed}") for seed in (1, 2)]
    rows = given.select("row", "key", "vec", "label", *hashes)
    folded = rows.where(F.col("h1").isNotNull()).groupBy("h1", "h2").agg(
        F.first("label").alias("label"), F.first("vec").alias("vec"), F.count("*").alias("copies"), F.min("key").alias("low")
    )
    points = written(folded.withColumn("dim", F.size("vec")).withColumn("node", F.monotonically_increasing_id()), "tree-folded")
    found = near_points(points.select("node", *GROUP, "vec", "copies"), cosine)
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")), [])
    placed = points.select("node", "h1", "h2", "copies", "low").join(counts, "node", "left").join(roots, "node", "left")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    lowest = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    answers = placed.join(lowest, "root").select("h1", "h2", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id")
    joined = rows.select("row", "key", "h1", "h2").join(answers, ["h1", "h2"], "left")
    component = F.when(F.col("h1").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return joined.select("row", "key", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id")).select(
        "row", "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept")
    )
