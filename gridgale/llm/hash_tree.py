"""Sharding by a hierarchical weighted hash tree.

Shards are the leaves of a tree of regions, racks and shards. A document goes down the
tree: at each node every child makes a weighted draw from the document's key, and the
child with the best draw gets it. A child is drawn in proportion to its weight, the sum
of its shards' weights. Draws of one child do not depend on the others, so a change of
weight moves documents only into or out of the subtrees whose weight changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARDS = 24
RACK = 4  # shards in a rack
REGION = 3  # racks in a region


def tree(shards: int, weights: dict[int, float] | None = None) -> dict[int, dict[int, dict[int, float]]]:
    """Region -> rack -> shard -> weight. The layout of the first shards does not depend on
    how many follow."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    out: dict[int, dict[int, dict[int, float]]] = {}
    for s in range(shards):
        weight = float((weights or {}).get(s, 1.0))
        if weight < 0:
            raise ValueError(f"shard {s} has a negative weight")
        out.setdefault(s // (RACK * REGION), {}).setdefault(s // RACK, {})[s] = weight
    return out


def _drawn(key: Column, level: str, weights: dict[int, float]) -> Column:
    """The child with the smallest exponential draw; ties go to the smaller child."""
    live = {child: w for child, w in weights.items() if w > 0}
    if not live:
        raise ValueError(f"a {level} without weight")
    if len(live) == 1:
        return F.lit(next(iter(live)))
    draws = []
    for child, w in sorted(live.items()):
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(f"{level}/{child}"), key), 11)
        draws.append(F.struct((-F.log((bits + F.lit(0.5)) / F.lit(2.0**53)) / w).alias("draw"), F.lit(child).alias("child")))
    return F.least(*draws)["child"]


def shard_of(key: Column, shards: int, weights: dict[int, float] | None = None) -> Column:
    """The shard of a key; a null key has its fixed place as well."""
    regions = tree(shards, weights)
    region = _drawn(key, "region", {r: sum(sum(rack.values()) for rack in racks.values()) for r, racks in regions.items()})

    def choose(index: Column, options: dict[int, Column]) -> Column:
        out = None
        for value, column in options.items():
            out = F.when(index == value, column) if out is None else out.when(index == value, column)
        return out

    def weighted(nodes: dict[int, float]) -> bool:
        return any(w > 0 for w in nodes.values())

    by_region = {}
    for r, racks in regions.items():
        sums = {k: sum(rack.values()) for k, rack in racks.items()}
        if weighted(sums):
            by_region[r] = _drawn(key, "rack", sums)
    rack = choose(region, by_region)
    by_rack = {
        k: _drawn(key, "shard", shard)
        for racks in regions.values() for k, shard in racks.items() if weighted(shard)
    }
    return choose(rack, by_rack).cast("int")


def shard_documents(docs: DataFrame, key: str = "doc_id", shards: int = SHARDS, weights: dict[int, float] | None = None) -> DataFrame:
    """`row` (the document) with `shard`, and `grown_shard`, its place once there is one more
    shard of weight 1, which stands in a region of its own if the last region is full.

    Only the key and the tree decide, so rows that repeat a key share a shard, a null key
    has a fixed one, and texts may be null. An empty table stays empty. One column pass,
    no shuffle.
    """
    from gridgale.llm.common import packed

    value = F.col("row")[key]
    grown = {**{s: 1.0 for s in range(shards)}, **(weights or {}), shards: 1.0}
    return packed(docs).select(
        "row", shard_of(value, shards, weights).alias("shard"), shard_of(value, shards + 1, grown).alias("grown_shard")
    )
