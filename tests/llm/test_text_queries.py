"""The registered text queries against their SQL, and the pipeline against plain Python."""

from collections import Counter, defaultdict
from pathlib import Path

import pytest

import compare
import corpus_pipeline
from gridgale.llm import mixing, packing, toxicity
from gridgale.llm.common import documents, written
from gridgale.llm.oracles import ORACLES
from gridgale.llm.queries import QUERIES
from test_lines_and_copies import components_by_hand, lines_by_hand
from test_mix_pack_shard import check_packs, targets_by_hand

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.mark.parametrize("name", list(ORACLES))
def test_text_query_equals_sql(spark, name):
    _, _, verdict = compare.compare(spark, compare.connect(SF), SF, name, QUERIES[name], ORACLES[name])
    assert verdict.startswith("ok"), verdict


def test_ten_operators_and_the_pipeline():
    assert [int(n[2:].split("_")[0]) for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]


def test_stages_do_what_they_say(spark):
    docs = documents(spark, SF)
    before = {r["doc_id"]: r for r in docs.collect()}
    steps = [before]
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = written(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == documents(spark, SF).columns
        steps.append({r["doc_id"]: r for r in docs.collect()})
    model = toxicity.fit(documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_documents(documents(spark, SF), model).select("row.doc_id", "score").collect()}
    assert steps[1] == {d: r for d, r in before.items() if scores[d] < 0.5} and 0 < len(steps[1]) < len(before)
    kept = {d: t for d, _, _, t in lines_by_hand([(d, r["text"], None) for d, r in steps[1].items()])}
    assert {d: r["text"] for d, r in steps[2].items()} == kept
    groups = components_by_hand([(d, r["text"], None) for d, r in steps[2].items()])
    assert steps[3] == {d: steps[2][d] for d, _, c in groups if c == d}

    mixed = written(corpus_pipeline.STAGES[3][1](spark, docs, SF), "test-mixing")
    assert mixed.columns == docs.columns
    sizes, words, passes = Counter(), Counter(), Counter()
    for r in steps[3].values():
        sizes[r["source"]] += len(r["text"].split())
    for r in mixed.collect():
        words[r["source"]] += len(r["text"].split())
        passes[r["doc_id"]] += 1
        assert r["n_chars"] == len(r["text"]) and set(r["text"].split()) <= set(steps[3][r["doc_id"]]["text"].split())
    assert max(passes.values()) <= mixing.MOST
    for source, target in targets_by_hand(dict(sizes)).items():
        assert abs(words[source] - target) <= 0.05 * target + 2 * mixing.BLOCK, source

    pieces = corpus_pipeline.STAGES[4][1](spark, mixed, SF).collect()
    check_packs(pieces)
    per_doc = defaultdict(int)
    for p in pieces:
        per_doc[p["doc_id"]] += len(p["ids"]) // packing.ID_BYTES
        assert len(p["ids"]) == packing.ID_BYTES * p["length"]
    assert set(per_doc) == set(passes)


def test_run_goes_through_all_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and "ids" in out.columns
