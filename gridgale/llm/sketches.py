"""Invertible Bloom lookup sketches of sets of 64-bit digests, many at a time.

A sketch has three tables of cells. A digest goes into one cell of each, where
the number of digests, their sum and the sum of their checks are kept. Sketches subtract
cell by cell, which leaves the digests that are in one set only; cells that hold a single
one are peeled off until nothing is left, or the sketch was too small.
"""

from __future__ import annotations

import numpy as np

from gridgale.llm.common import mix64

TABLES = 3
SAMPLE_WIDTH = 8


def checks(digests: np.ndarray) -> np.ndarray:
    return mix64(digests ^ np.uint64(0xA5A5A5A55A5A5A5A)) & np.uint64(0xFFFFFFFF)


def places(digests: np.ndarray, width: int) -> np.ndarray:
    """(TABLES, n): the cell of each digest in each table, numbered over all tables."""
    return np.stack([
        (mix64(digests + np.uint64(t + 1)) % np.uint64(width)).astype(np.int64) + t * width for t in range(TABLES)
    ])


def add(counts: np.ndarray, sums: np.ndarray, marks: np.ndarray, sketch: np.ndarray, digests: np.ndarray, signs: np.ndarray, width: int) -> None:
    """Put digests into flat cells; `sketch` says which sketch each belongs to."""
    at = (places(digests, width) + sketch * (TABLES * width)).ravel()
    with np.errstate(over="ignore"):
        signed = signs.astype(np.uint64)
        np.add.at(counts, at, np.tile(signs, TABLES))
        np.add.at(sums, at, np.tile(digests * signed, TABLES))
        np.add.at(marks, at, np.tile(checks(digests) * signed, TABLES))


def empty(sketches: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    cells = sketches * TABLES * width
    return np.zeros(cells, np.int64), np.zeros(cells, np.uint64), np.zeros(cells, np.uint64)


def peel(counts: np.ndarray, sums: np.ndarray, marks: np.ndarray, width: int):
    """(whole, sketch, digest, sign): which sketches came out whole, and what was in them."""
    size = TABLES * width
    found = []
    look = np.flatnonzero(np.abs(counts) == 1)
    while len(look):
        sign = counts[look]
        with np.errstate(over="ignore"):
            digest, mark = sums[look] * sign.astype(np.uint64), marks[look] * sign.astype(np.uint64)
        pure = checks(digest) == mark
        sketch, digest, sign = look[pure] // size, digest[pure], sign[pure]
        order = np.lexsort((digest, sketch))
        sketch, digest, sign = sketch[order], digest[order], sign[order]
        once = np.ones(len(order), bool)
        once[1:] = (sketch[1:] != sketch[:-1]) | (digest[1:] != digest[:-1])
        sketch, digest, sign = sketch[once], digest[once], sign[once]
        if not len(sketch):
            break
        found.append((sketch, digest, sign))
        add_at = (places(digest, width) + sketch * size).ravel()
        with np.errstate(over="ignore"):
            np.subtract.at(counts, add_at, np.tile(sign, TABLES))
            np.subtract.at(sums, add_at, np.tile(digest * sign.astype(np.uint64), TABLES))
            np.subtract.at(marks, add_at, np.tile(checks(digest) * sign.astype(np.uint64), TABLES))
        touched = np.unique(add_at)
        look = touched[np.abs(counts[touched]) == 1]
    left = (counts != 0) | (sums != 0) | (marks != 0)
    whole = ~left.reshape(-1, size).any(axis=1)
    parts = [np.concatenate(x) if found else np.zeros(0, t) for x, t in zip(zip(*found) if found else ([], [], []), (np.int64, np.uint64, np.int64))]
    return whole, *parts


def estimates(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """About how many digests differ, from the counts in small sketches of every eighth digest.

    Cells that hold as many of the one as of the other cancel, and the squares of the others
    add up to the number of differences.
    """
    sets = [x[x & np.uint64(7) == 0] for x in (*one, *two)]
    n = np.array([len(x) for x in sets])
    pair = np.repeat(np.tile(np.arange(len(one)), 2), n)
    signs = np.repeat(np.array([1, -1]), [n[: len(one)].sum(), n[len(one) :].sum()])
    counts = np.zeros(len(one) * TABLES * SAMPLE_WIDTH, np.int64)
    np.add.at(counts, (places(np.concatenate(sets), SAMPLE_WIDTH) + pair * (TABLES * SAMPLE_WIDTH)).ravel(), np.tile(signs, TABLES))
    return 8 * (counts.reshape(len(one), -1) ** 2).sum(axis=1) // TABLES


def differences(one: list[np.ndarray], two: list[np.ndarray], width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pair of sets what is only in the first and only in the second.

    Sketches are as wide as the estimate asks for, and at least `width`. What does not
    peel is sketched again, twice as wide, until all pairs have come out.
    """
    out: list = [None] * len(one)
    todo: dict[int, list[int]] = {}
    for p, near in enumerate((estimates(one, two) * 3 // 5).tolist() if one else []):
        todo.setdefault(max(width, 1 << near.bit_length()), []).append(p)
    while todo:
        wide = min(todo)
        pairs = todo.pop(wide)
        cells = empty(len(pairs), wide)
        sets = [x[p] for x in (one, two) for p in pairs]
        n = np.array([len(x) for x in sets])
        signs = np.repeat(np.array([1, -1]), [n[: len(pairs)].sum(), n[len(pairs) :].sum()])
        add(*cells, np.repeat(np.tile(np.arange(len(pairs)), 2), n), np.concatenate(sets), signs, wide)
        whole, sketch, digest, sign = peel(*cells, wide)
        order = np.lexsort((sign, sketch))
        sketch, digest, sign = sketch[order], digest[order], sign[order]
        ends = np.searchsorted(sketch * 2 + (sign > 0), np.arange(2 * len(pairs) + 1))
        for k, p in enumerate(pairs):
            if whole[k]:
                out[p] = digest[ends[2 * k + 1] : ends[2 * k + 2]], digest[ends[2 * k] : ends[2 * k + 1]]
            else:
                todo.setdefault(2 * wide, []).append(p)
    return out
