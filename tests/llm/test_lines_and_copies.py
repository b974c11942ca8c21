"""Line dedup and near duplicates against plain Python."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridgale.llm import common, line_dedup, near_dedup, perfect_hash, stages
from textdata import COLUMNS, SCHEMA, odd_rows, prose, table

SPACES = " \t\n\x0b\f\r"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def lines_by_hand(rows, least=5, chars=40):
    holders = {}
    for d, t, _ in rows:
        for line in (t or "").split("\n"):
            key = line.strip(SPACES).translate(LOWER)
            if len(key) >= chars:
                holders.setdefault(key, set()).add(d)
    out = []
    for d, t, _ in rows:
        kept = []
        lines = (t or "").split("\n")
        for line in lines:
            held = holders.get(line.strip(SPACES).translate(LOWER), set())
            if len(held) < least or (d is not None and d == max(x for x in held if x is not None)):
                kept.append(line)
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def deduped(df, **more):
    return [(r["d"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in line_dedup.drop_repeated_lines(df, **more).select(
        F.col("row.doc_id").alias("d"), "n_lines", "n_dropped", "kept_text").collect()]


def ordered(rows):
    return sorted(rows, key=repr)


def test_lines_of_odd_documents(spark):
    rows = odd_rows()
    want = lines_by_hand(rows)
    assert sum(n for _, _, n, _ in want) > 5
    assert ordered(deduped(table(spark, rows))) == ordered(want)


def test_a_line_in_every_document_and_many_shards(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 40)
    monkeypatch.setattr(line_dedup, "TASK_PROBES", 50)
    common = [prose(s, 12).replace("\n", " ") for s in range(150)]
    rows = [(d, "\n".join([common[0], *(common[(d * k) % 150] for k in range(1, 9)), prose(1000 + d, 10)]), "s") for d in range(300)]
    assert ordered(deduped(table(spark, rows))) == ordered(lines_by_hand(rows))


def test_lines_of_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    out = line_dedup.drop_repeated_lines(empty)
    assert out.collect() == [] and out.schema["row"].dataType.fieldNames() == COLUMNS


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 30_000])
def test_perfect_hash_is_minimal_and_knows_strangers(n):
    rng = np.random.default_rng(n)
    h = rng.integers(0, 2**63, (2, 2 * n), dtype=np.uint64)
    h[0, 1 : n // 10] = h[0, 0] if n else 0  # equal in one half only
    sizes, bits = perfect_hash.build(h[0, :n], h[1, :n])
    index = perfect_hash.Index(sizes, bits, np.zeros(n, np.uint64))
    at = index.locate(h[0, :n], h[1, :n])
    assert sorted(at.tolist()) == list(range(n))
    prints = np.zeros(n, np.uint64)
    prints[at] = perfect_hash.fingerprint(h[0, :n], h[1, :n])
    whole = perfect_hash.Index(sizes, bits, prints)
    assert (whole.find(h[0, :n], h[1, :n]) == at).all() and (whole.find(h[0, n:], h[1, n:]) == -1).all()


def components_by_hand(rows):
    sets = []
    for d, t, _ in rows:
        words, word = [], ""
        for ch in (t or "").translate(LOWER) + " ":
            if ch in SPACES:
                words += [word] if word else []
                word = ""
            else:
                word += ch
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    known = [i for i, (d, _, _) in enumerate(rows) if d is not None]
    root = {rows[i][0]: rows[i][0] for i in known}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in known:
        for j in known:
            x, y = sets[i], sets[j]
            if i < j and x and y and 100 * len(x & y) >= 75 * len(x | y):
                a, b = sorted((find(rows[i][0]), find(rows[j][0])))
                root[b] = a
    return [(d, len(s), None if d is None else find(d)) for (d, _, _), s in zip(rows, sets)]


def found(df):
    return [(r["id"], r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(df).collect()]


def test_components_of_odd_documents(spark):
    rows = odd_rows()
    want = components_by_hand(rows)
    assert (9, 197, 7) in want
    assert ordered(found(table(spark, rows))) == ordered(want)


def test_groups_chains_and_a_shared_passage(spark):
    base, passage = prose(5, 120).split(" "), prose(6, 60)
    rows, at = [], 1000
    for g in range(40):  # a group of near copies
        text = list(base)
        text[(g * 3) % 120] = f"changed{g}"
        rows.append((at := at - 7, " ".join(text), "s"))
    chain = prose(8, 90).split(" ")
    for g in range(25):  # each step is near the one before, its ends are not
        rows.append((2000 + (g * 11) % 25, " ".join(chain[g:] + [f"new{i}" for i in range(g)]), "s"))
    rows += [(5000 + g, prose(300 + g, 40) + " " + passage + " " + prose(700 + g, 30), "s") for g in range(60)]
    rows += [(6000 + g, prose(900 + g, 3 + g % 5), "s") for g in range(30)]
    want = components_by_hand(rows)
    assert len({c for _, _, c in want}) < len(rows) - 55
    assert ordered(found(table(spark, rows))) == ordered(want)


def test_signatures_within_the_distance_share_a_key(spark):
    rng = np.random.default_rng(1)
    one = rng.integers(0, 2**16, (300, near_dedup.POSITIONS), dtype=np.uint64)
    two = one.copy()
    for i, row in enumerate(two):
        row[rng.choice(near_dedup.POSITIONS, i % (near_dedup.DISTANCE + 1), replace=False)] ^= np.uint64(1 + i % 65535)

    def longs(x):
        shifts = np.uint64(16) * (np.arange(near_dedup.POSITIONS, dtype=np.uint64) % np.uint64(4))
        return (x << shifts).reshape(len(x), near_dedup.CHUNKS, 4).sum(axis=2, dtype=np.uint64).view(np.int64)

    names = near_dedup.SIGN
    a, b = (spark.createDataFrame([(i, *map(int, r)) for i, r in enumerate(longs(x))], "i int, " + ", ".join(f"{n} bigint" for n in names)) for x in (one, two))
    keyed = a.select("i", near_dedup.lookup_keys().alias("k")).join(b.select("i", near_dedup.lookup_keys().alias("l")), "i")
    assert keyed.where(~F.arrays_overlap("k", "l")).count() == 0
    far = a.join(b.select("i", *[F.col(n).alias(f"o_{n}") for n in names]), "i").select(
        "i", near_dedup.distance([F.col(n) for n in names], [F.col(f"o_{n}") for n in names]).alias("d")
    ).collect()
    assert {r["i"]: r["d"] for r in far} == {i: int((x != y).sum()) for i, (x, y) in enumerate(zip(one, two))}


def test_copies_of_an_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_stages_keep_columns_and_one_of_each_group(spark):
    rows = odd_rows()
    lines = stages.without_shared_lines(spark, table(spark, rows), "")
    kept = stages.without_near_copies(spark, table(spark, rows), "")
    assert lines.columns == kept.columns == COLUMNS and lines.count() == len(rows)
    got = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    want = sorted({d for d, _, c in components_by_hand(rows) if d is not None and c == d}) + [None] * 3
    assert got == sorted(want, key=repr)
    assert {r["n_chars"] == len(r["text"]) for r in lines.collect()} == {True}


def test_texts_with_very_many_shared_lines(spark):
    lines = [f"line number {i} that is shared by all of the documents" for i in range(6000)]
    rows = [(k, "\n".join(lines + [f"own {k}"] + [" " + lines[0].upper()]), "a") for k in range(5)]
    got = line_dedup.drop_repeated_lines(table(spark, rows), carry=["doc_id"]).select("row.doc_id", "n_lines", "n_dropped", "kept_text")
    want = [(k, 6002, 0 if k == 4 else 6001, rows[4][1] if k == 4 else f"own {k}") for k in range(5)]
    assert sorted(map(tuple, got.collect())) == want


def test_inner_tables_go_once_the_next_stage_reads_what_was_written(spark, tmp_path, monkeypatch):
    removed = []
    monkeypatch.setattr(common, "remove", lambda _, path: removed.append(path))
    app = spark.sparkContext.applicationId
    common._left.pop(app, None)
    rows = table(spark, odd_rows())
    first = stages.without_shared_lines(spark, rows, "")
    inner = [path for path, _ in common._left[app]]
    stages.without_near_copies(spark, rows, "")  # documents that were not written
    assert inner and removed == []
    first.write.parquet(str(tmp_path / "first"))
    stages.without_shared_lines(spark, spark.read.parquet(str(tmp_path / "first")), "")
    assert set(inner) <= set(removed) and not {path for path, _ in common._left[app]} & set(removed)
