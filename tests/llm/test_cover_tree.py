"""Near vectors against all pairs in plain numpy."""

from collections import Counter

import numpy as np
import pytest

from gridgale.llm import cover_tree

SCHEMA = "vec_id bigint, embedding array<{}>, label int, row string, node string, n_links string, h1 string, cell string"


def linked_by_hand(rows, cosine=0.93):
    """(vec_id, n_links, component_id) for (vec_id, vector, label)."""
    def sound(v, label):
        return label is not None and v is not None and len(v) > 0 and None not in v and np.isfinite(np.array(v, float)).all() and any(v)

    unit = [None] * len(rows)
    for i, (_, v, label) in enumerate(rows):
        if sound(v, label):
            x = np.array(v, float) / np.abs(np.array(v, float)).max()
            unit[i] = x / np.sqrt((x * x).sum())
    links = [
        [j for j in range(len(rows)) if j != i and unit[j] is not None and rows[j][2] == rows[i][2]
         and len(unit[j]) == len(unit[i]) and (unit[i] * unit[j]).sum() >= cosine]
        if unit[i] is not None else [] for i in range(len(rows))
    ]
    out = []
    for i, row in enumerate(rows):
        seen, waiting = {i}, [i]
        while waiting:
            for j in links[waiting.pop()]:
                if j not in seen:
                    seen.add(j)
                    waiting.append(j)
        keys = [rows[j][0] for j in seen if rows[j][0] is not None]
        low = min(keys, default=None)
        out.append((row[0], len(links[i]), low, row[0] == low))
    return Counter(out)


def found(spark, rows, kind="float", **more):
    df = spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA.format(kind))
    out = cover_tree.near_vectors(df, **more)
    assert out.select("row.*").columns == df.columns
    return Counter(tuple(r) for r in out.select("row.vec_id", "n_links", "component_id", "kept").collect())


def single(v):
    return None if v is None else [None if x is None else float(np.float32(x)) for x in v]


def groups(rng, dim, spreads, size):
    """Vectors around centres, some groups tight and some at about the threshold."""
    out = []
    for spread in spreads:
        centre = rng.normal(size=dim)
        out += [single(centre + spread * rng.normal(size=dim)) for _ in range(size)]
    return out


def odd_vectors(rng):
    base = groups(rng, 6, [0.1, 0.2, 0.3, 0.4], 12)
    rows = [(i, v, i % 2) for i, v in enumerate(base)]
    return rows + [
        (100, None, 0), (101, [], 0), (102, [0.0] * 6, 0), (103, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (104, [float("nan")] * 6, 1),
        (105, [float("inf"), 1.0, 0.0, 0.0, 0.0, 0.0], 1), (106, base[0], None), (107, base[0], 0), (107, base[0], 0), (None, base[0], 0),
        (None, [-x for x in base[0]], 0), (None, None, None), (108, single([x * 8 for x in base[1]]), 1), (109, base[2][:5], 0),
        (110, [1e38] * 6, 0), (111, [1e-38] * 6, 0), (112, [3.0], 0), (113, [5.0], 0), (114, [-5.0], 0),
        (115, [-0.0] * 5 + [1.0], 0), (116, [0.0] * 5 + [1.0], 0),
    ]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_odd_vectors(spark, kind):
    rows = odd_vectors(np.random.default_rng(2))
    assert found(spark, rows, kind) == linked_by_hand(rows)


def test_divided_labels(spark, monkeypatch):
    """Small blocks and few levels, so that cells are divided, cut by hash and met."""
    rng = np.random.default_rng(4)
    vectors = groups(rng, 8, [0.02, 0.1, 0.2, 0.25, 0.3, 1.0, 1.0], 40) + [[1.0] * 8] * 60
    rows = [(i, v, 0 if i % 5 else 1) for i, v in enumerate(vectors)]
    want = linked_by_hand(rows)
    for block, levels in ((25, 12), (20, 1), (30, 0)):
        monkeypatch.setattr(cover_tree, "BLOCK", block)
        monkeypatch.setattr(cover_tree, "LEVELS", levels)
        assert found(spark, rows) == want


@pytest.mark.parametrize("cosine", [0.5, 0.93, 0.999, 1.0])
def test_trees_find_what_all_pairs_find(cosine):
    rng = np.random.default_rng(7)
    for dim, spreads in ((2, [0.3, 1.0]), (5, [0.001, 0.1, 0.3]), (64, [0.02, 0.3, 1.0])):
        raw = np.array(groups(rng, dim, spreads, 50) + [[2.0] + [1.0] * (dim - 1), [4.0] + [2.0] * (dim - 1)])
        weights = rng.integers(1, 4, len(raw))
        trees = []
        for part in (slice(0, len(raw), 2), slice(1, len(raw), 2)):
            order, nodes = cover_tree.grow(raw[part])
            ids = np.arange(len(raw))[part][order]
            assert sorted(ids) == list(range(len(raw))[part])
            trees.append(cover_tree.CoverTree(raw[ids], weights[ids], ids, **nodes))
        for tree in trees:
            for node in range(len(tree.begin)):
                away = np.sqrt(np.square(tree.u[tree.begin[node]:tree.end[node]] - tree.u[tree.begin[node]]).sum(axis=1))
                assert away.max() <= tree.radius[node] + 1e-12
                kids = tree.radius[tree.child[node]:tree.child_end[node]]
                assert (kids <= tree.radius[node] / 2).all()
        _, u = cover_tree.unit(raw)
        near = (raw @ raw.T) / np.sqrt(np.outer((raw * raw).sum(1), (raw * raw).sum(1))) >= cosine
        near |= u @ u.T >= cosine + 1e-9
        for a, b in ((trees[0], trees[0]), (trees[1], trees[1]), (trees[0], trees[1])):
            got = {i: n for i, n, _ in zip(*(c.tolist() for c in cover_tree.Links(a, b, cosine).rows()))}
            want = Counter()
            for i in a.ids.tolist():
                for j in b.ids.tolist():
                    if i != j and near[i, j]:
                        want[i] += int(weights[j])
                        if a is not b:
                            want[j] += int(weights[i])
            assert got == dict(want)


def test_a_group_of_near_copies_is_not_paired(monkeypatch):
    rng = np.random.default_rng(1)
    raw = np.ones(16) + 1e-3 * rng.normal(size=(1000, 16))
    order, nodes = cover_tree.grow(raw)
    tree = cover_tree.CoverTree(raw[order], np.ones(1000, np.int64), order, **nodes)
    found = cover_tree.Links(tree, tree, 0.93)
    assert (found.rows()[1] == 999).all() and sum(e.shape[1] for e in found.edges) == 1


def test_empty_table(spark):
    assert found(spark, []) == Counter()
