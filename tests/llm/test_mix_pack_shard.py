"""Mixing, packing and sharding against plain Python."""

import gc
import random
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridgale.llm import hash_tree, mixing, packing, stages
from gridgale.llm.common import ranked, written
from textdata import COLUMNS, SCHEMA, odd_rows, prose, table


def targets_by_hand(sizes, volume=1.5):
    """Share, stop those above, share again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left = {}, volume * sum(sizes.values())
    while True:
        free = [s for s in names if s not in target]
        if not free:
            return target
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 3, 50, 700, 10_000]) for s in [None, "", "Z", "a", "é", "\U0001f600", "b", "ab"][: 3 + 2 * seed]}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    want = targets_by_hand(sizes)
    assert got == pytest.approx(want)


def test_quotas_go_to_the_highest_quotients(spark):
    rng = random.Random(3)
    cells = [(s, f"s{i}", 0, b := rng.randint(0, 30), rng.random() * 2 * b) for s in range(12) for i in range(rng.randint(1, 9))]
    got = mixing.quotas(spark.createDataFrame(cells, "shard bigint, source string, words bigint, blocks bigint, wanted double")).collect()
    for shard in range(12):
        mine = [c for c in cells if c[0] == shard]
        seats = int(sum(c[4] for c in mine) + 0.5)
        quotients = sorted(((-w / (2 * a + 1), s, a) for _, s, _, b, w in mine for a in range(2 * b)))[:seats]
        want = Counter(s for _, s, _ in quotients)
        assert {r["source"]: r["quota"] for r in got if r["shard"] == shard} == {c[1]: want[c[1]] for c in mine}


def test_mix_of_odd_documents(spark):
    rows = odd_rows() + [(100 + i, prose(i, 60), "c") for i in range(40)]
    docs = table(spark, rows)
    mix = mixing.mix_sources(docs, shard_words=1500, block_words=8)
    got = [(r["d"], r["source"], r["size"], r["target"], r["taken"]) for r in mix.select(
        F.col("row.doc_id").alias("d"), "row.source", "size", "target", "taken").collect()]
    assert len(got) == len(rows) and sorted(g[2] for g in got) == sorted(len((t or "").split()) for _, t, _ in rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = targets_by_hand(dict(sizes))
    for source, target in want.items():
        mine = [g for g in got if g[1] == source]
        assert all(g[3] == pytest.approx(target) and 0 <= g[4] <= 2 * g[2] for g in mine)
        assert abs(sum(g[4] for g in mine) - target) <= 0.05 * sum(sizes.values()), source
    again = mixing.mix_sources(docs.repartition(7), shard_words=1500, block_words=8)
    assert sorted(map(repr, again.select("row.doc_id", "taken").collect())) == sorted(map(repr, mix.select("row.doc_id", "taken").collect()))
    texts = mixing.mixed_texts(mix)
    assert texts.columns == COLUMNS
    words = Counter()
    for r in texts.collect():
        words[r["doc_id"]] += len(r["text"].split())
        assert set(r["text"].split()) <= {w for d, t, _ in rows if d == r["doc_id"] for w in (t or "").split()}
    taken = Counter()
    for g in got:
        taken[g[0]] += g[4]
    assert +words == +taken


def test_a_large_hot_source_comes_near_its_target(spark):
    rows = [(i, " ".join(["w"] * (i % 90)), "hot" if i % 3 else f"s{i % 11}") for i in range(4000)]
    mix = mixing.mix_sources(table(spark, rows), shard_words=20_000).groupBy("row.source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"))
    assert all(abs(r["taken"] - r["target"]) <= 0.03 * r["target"] for r in mix.collect())


def test_mix_of_an_empty_table(spark):
    mix = mixing.mix_sources(spark.createDataFrame([], SCHEMA))
    assert mix.collect() == [] and mixing.mixed_texts(mix).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_packs_hold_every_piece_once(seed):
    rng = random.Random(seed)
    histogram = Counter(rng.choice([rng.randint(1, 4096), 4096, 5, 2000]) for _ in range(3000))
    if seed == 0:
        histogram = {5: 1_000_000, 4096: 7, 2049: 10}
    patterns = packing.shortest_pack_first(histogram)
    counts = Counter()
    for pattern, packs in patterns:
        assert sum(n * c for n, c in pattern) <= 4096 and packs > 0
        for n, c in pattern:
            counts[n] += c * packs
    assert counts == Counter(histogram)
    padding = sum(packs * (4096 - sum(n * c for n, c in p)) for p, packs in patterns)
    total = sum(n * c for n, c in histogram.items())
    assert padding <= 0.02 * total + 4 * 4096 + (10 * 2047 if seed == 0 else 0)


def test_the_emptiest_pack_comes_first():
    assert sorted(packing.shortest_pack_first({7: 1, 5: 1, 2: 1, 3: 1}, 10)) == [(((5, 1), (3, 1)), 1), (((7, 1), (2, 1)), 1)]


def packed_rows(df, **more):
    return packing.pack_documents(df, **more).collect()


def check_packs(pieces, size=4096):
    places = defaultdict(list)
    for p in pieces:
        places[p["sequence_id"]].append((p["offset"], p["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= size


def test_odd_documents_are_packed_whole(spark, monkeypatch):
    from tokenizers import Tokenizer
    import public_tokenizers

    monkeypatch.setattr(packing, "BATCH_BYTES", 5000)
    rows = odd_rows() + [
        (200, "don't I'LL 'tis x's' Éole <|endoftext|> <|ENDOFTEXT|> naïve İstanbul Σας a² １２ é \ttab\x1ca 日本語 😀s ''s a\xadb ×", "z")
    ]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = packed_rows(table(spark, rows))
    check_packs(pieces)
    got = defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u2")
        assert p["ids_crc32"] == zlib.crc32(ids.astype("<u4").tobytes()) and len(ids) == p["length"]
        got[(p["row"]["doc_id"], p["doc_tokens"], p["start"])].append(ids.tolist())
    want = defaultdict(list)
    for d, t, _ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        for start in range(0, len(ids), 4096):
            want[(d, len(ids), start)].append(ids[start : start + 4096])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_many_equal_documents_and_none(spark):
    pieces = packed_rows(table(spark, [(i % 50, "the same few words", "s") for i in range(3000)]), with_ids=False)
    check_packs(pieces)
    assert len(pieces) == 3000 and len({p["sequence_id"] for p in pieces}) == -(-3000 * 5 // 4095)
    assert packed_rows(spark.createDataFrame([], SCHEMA)) == []


def test_ranks_have_no_gaps(spark):
    df = written(spark.range(5000).selectExpr("if(id < 4000, null, id % 3) AS g", "id % 700 AS v"), "ranks")
    got = defaultdict(list)
    for r in ranked(df, ["g"], ["v"], "place", per_bucket=300).collect():
        got[r["g"]].append(r["place"])
    assert {g: sorted(v) for g, v in got.items()} == {g: list(range(len(v))) for g, v in got.items()} and len(got[None]) == 4000


def shards(df, n, weights=None):
    return {r["k"]: r["s"] for r in df.select(F.col("doc_id").alias("k"), hash_tree.shard_of(F.col("doc_id"), n, weights).alias("s")).collect()}


def test_one_more_shard_takes_rows_only_into_itself(spark):
    df = spark.range(6000).withColumnRenamed("id", "doc_id")
    out = hash_tree.shard_documents(df).select("row.doc_id", "shard", "grown_shard").collect()
    moved = [r for r in out if r["shard"] != r["grown_shard"]]
    assert {r["grown_shard"] for r in moved} == {24} and 0.02 < len(moved) / 6000 < 0.06
    counts = Counter(r["shard"] for r in out)
    assert set(counts) == set(range(24)) and max(counts.values()) < 1.4 * 250 and min(counts.values()) > 0.6 * 250
    assert shards(df, 25) == {r["doc_id"]: r["grown_shard"] for r in out}


def test_a_weight_moves_rows_only_in_its_subtrees(spark):
    df = spark.range(4000).withColumnRenamed("id", "doc_id")
    before, after = shards(df, 24), shards(df, 24, {0: 3.0, 1: 0.0})
    assert 1 not in after.values()
    for k, s in before.items():
        # Region 0 and rack 0 gained weight: nothing leaves them but from shard to shard.
        if s // 12 == 0:
            assert after[k] // 12 == 0
        if s // 4 == 0:
            assert after[k] // 4 == 0
        if s // 12 == 1 and after[k] // 12 == 1:
            assert after[k] == s
    share = Counter(after.values())
    assert 2 < share[0] / (sum(share[s] for s in (2, 3)) / 2) < 4.5


def test_shards_of_odd_documents(spark):
    docs = table(spark, odd_rows())
    out = hash_tree.shard_documents(docs).collect()
    assert len(out) == len(odd_rows()) and len({r["shard"] for r in out if r["row"]["doc_id"] is None}) == 1
    assert hash_tree.shard_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        hash_tree.tree(0)


def test_mixing_stage_keeps_columns(spark):
    out = stages.mixed(spark, table(spark, odd_rows()), "")
    assert out.columns == COLUMNS and all(r["n_chars"] == len(r["text"]) for r in out.collect())


def test_an_encoder_ends_with_its_task():
    """It holds a tokenizer of some 40 MB, which workers that are used again would gather."""
    encoder = packing.WordEncoder(packing._tokenizer(packing.TOKENIZER))
    assert encoder.word("Plain") == encoder.word("plain") != b""
    gone = weakref.ref(encoder)
    gc.disable()
    try:
        del encoder
        assert gone() is None
    finally:
        gc.enable()
