"""Overlaps of two tokenizers' tokens against a walk over all tokens in plain Python."""

import hashlib
import random
from collections import Counter
from pathlib import Path

import pytest

from gridgale.llm import alignment
from gridgale.llm.common import documents
from gridgale.llm.queries import QUERIES
from textdata import odd_rows, prose, table

SF = "/root/testdata/sf0.001"
FIGURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def encoders():
    """Both tokenizers straight from their files, each giving (id, bytes) of whole texts."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    bpe.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}

    def a(text):
        return [(i, bytes(byte_of[c] for c in bpe.id_to_token(i))) for i in bpe.encode(" " + text, add_special_tokens=False).ids]

    def b(text):
        out = []
        for i in model.encode(text):
            piece = model.id_to_piece(i)
            out.append((i, bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
        return out

    return a, b


def spans(tokens):
    out, at = [], 0
    for i, t in tokens:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def place(side):
    """How many tokens end at or before the end of each."""
    return {0: 0} | {e: n + 1 for n, (_, _, e) in enumerate(side)}


def aligned_by_hand(texts):
    a_of, b_of = encoders()
    counts, docs = Counter(), []
    for text in texts:
        a, b = (a_of(text), b_of(text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if not text or b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
            docs.append(None)
            continue
        a, b = spans(a), spans(b)
        links, j = [], 0
        for i, start, end in a:
            while b[j][2] <= start:
                j += 1
            k = j
            while k < len(b) and b[k][1] < end:
                links.append((i, b[k][0]))
                k += 1
        counts.update(links)
        place_a, place_b = place(a), place(b)
        ends, groups = sorted({e for *_, e in a} & {e for *_, e in b}), []
        for begin, end in zip([0, *ends], ends):
            inside = [",".join(str(i) for i, s, e in side[at[begin]:at[end]]) for side, at in ((a, place_a), (b, place_b))]
            groups.append("|".join(inside))
        docs.append((len(a), len(b), groups, links))
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if d is None else (
            d[0], d[1], len(d[2]), len(d[3]), sum(counts[p] == most[p[1]] for p in d[3]), sum(counts[p] for p in d[3]),
            hashlib.sha256(";".join(d[2]).encode()).hexdigest(),
        )
        for d in docs
    ]


def figures(rows):
    return sorted(tuple(r[c] for c in ["doc_id", *FIGURES]) for r in rows)


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_query_equals_walk(spark):
    given = documents(spark, SF).collect()
    want = [(r["doc_id"], *f) for r, f in zip(given, aligned_by_hand([r["text"] for r in given]))]
    got = QUERIES["op13_alignment"](spark, SF)
    assert got.columns[0] == "doc_id" and set(FIGURES) < set(got.columns)
    assert figures(got.collect()) == sorted(want)


def test_odd_rows(spark):
    rows = odd_rows() + [
        (40, "<|endoftext|> and <s> or </s>, <unk>", "z"), (41, "▁a ▁ b", "z"), (42, " lead  and   trail  \n\n  x\t\ty ", "z"),
        (43, "nbsp here wide\u0085next \x1c sep", "z"), (44, "a\u0000b", "z"), (45, "🏳️‍🌈 𝔘𝔫𝔦 é ﬁ Ⅷ ½", "z"),
        (46, "x" * 3000, "z"), (47, " ", "z"), (48, "don't we'll I'M it's 'twas 12,345.67", "z"),
    ]
    want = [(r[0], *f) for r, f in zip(rows, aligned_by_hand([r[1] for r in rows]))]
    out = alignment.align_documents(table(spark, rows))
    assert out.select("row.*").columns == table(spark, rows).columns
    got = out.select("row.doc_id", *FIGURES).collect()
    order = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted((tuple(r) for r in got), key=order) == sorted(want, key=order)


def test_small_blocks_add_up_alike(spark, monkeypatch):
    rows = odd_rows()
    whole = alignment.align_documents(table(spark, rows), carry=["doc_id"]).select("row.doc_id", *FIGURES).collect()
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 300)
    monkeypatch.setattr(alignment, "REMEMBERED", 20)
    cut = alignment.align_documents(table(spark, rows), carry=["doc_id"]).select("row.doc_id", *FIGURES).collect()
    assert Counter(map(tuple, whole)) == Counter(map(tuple, cut))


def test_segments_encode_like_whole_texts():
    a_of, b_of = encoders()
    rng = random.Random(5)
    marks = "ab Zé\t\n\r\x0b\x1f\x85  ​　ſ日Σ1٣½'s.,-_▁😀́ "
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    texts += [prose(i, 50).replace(" ", rng.choice([" ", "  ", " \n", "\n "]), i) for i in range(50)]
    both = alignment.Encoders(alignment.BYTE_RANKS, alignment.PIECES)
    assert both.apart
    a, b = both.sides(texts)
    for n, text in enumerate(texts):
        whole = (" " + text).encode()
        want = [a_of(text), b_of(text)]
        if any(b"".join(t for _, t in side) != whole for side in want):
            want = [[], []]
        for side, tokens in zip((a, b), want):
            assert side.ids[side.first[n]:side.first[n + 1]].tolist() == [i for i, _ in tokens], repr(text)


def test_empty_table(spark):
    assert alignment.align_documents(table(spark, [])).count() == 0
