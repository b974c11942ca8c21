"""Frequent phrases against counting every phrase in plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridgale.llm import collocations
from textdata import odd_rows, prose, table


def phrases_by_hand(rows, least, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) for (text, lang)."""
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, 6):
                counts[lang].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, seen in counts.items():
        candidates = {p: a for p, a in seen.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i:i + size]] = max(inside[p[i:i + size]], a)
        found = []
        for p, a in candidates.items():
            if 100 * inside[p] >= 100 * a:
                continue
            score, _, left, right = min(
                (1000 * a * totals[lang] // (seen[p[:k]] * seen[p[k:]]), k, seen[p[:k]], seen[p[k:]]) for k in range(1, len(p))
            )
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def wordy_rows():
    rng = random.Random(3)
    few = ["red", "Blue", "tin", "été", "日本", "a", "b"]
    rows = [(i, " ".join(rng.choice(few) for _ in range(rng.randint(1, 90))) + rng.choice([".", "\n", " ;x"]), "a") for i in range(60)]
    rows += [(100, "same " * 2000, "a"), (101, "x y " * 700, None), (102, prose(4, 300), "a"), (103, prose(4, 300), "a")]
    rows += [(110 + i, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen", "b") for i in range(5)]
    return rows + odd_rows()


def with_langs(spark, rows):
    return table(spark, rows).selectExpr("* EXCEPT (lang)", "CASE WHEN source = 'b' THEN 'de' WHEN source = 'a' THEN 'en' END AS lang")


def of(rows):
    return [(text, {"b": "de", "a": "en"}.get(source)) for _, text, source in rows]


@pytest.mark.parametrize("few_pairs", [1_000_000, 0])
@pytest.mark.parametrize("least", [3, 40])
def test_counts_equal_plain_python(spark, monkeypatch, few_pairs, least):
    monkeypatch.setattr(collocations, "FEW_PAIRS", few_pairs)
    rows = wordy_rows()
    got = collocations.collocations(with_langs(spark, rows), least=least)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == phrases_by_hand(of(rows), least)


def test_small_buffers_and_few_ranks(spark, monkeypatch):
    monkeypatch.setattr(collocations, "DISTINCT", 10)
    monkeypatch.setattr(collocations, "BATCH_BYTES", 500)
    rows = wordy_rows()
    got = collocations.collocations(with_langs(spark, rows), least=3, top=7)
    assert sorted(map(tuple, got.collect())) == phrases_by_hand(of(rows), 3, 7)


def test_chunks_overlap_and_do_not_depend_on_what_lies_far_off():
    rng = random.Random(1)
    words = [rng.choice(["u", "v", "w", "x", "y", "z"]).encode() for _ in range(900)]
    parts = list(collocations.chunks(words))
    joined = parts[0][0].split()
    for chunk, _ in parts[1:]:
        assert chunk.split()[:4] == joined[-4:]
        joined += chunk.split()[4:]
    assert joined == words and [last for _, last in parts] == [False] * (len(parts) - 1) + [True]
    moved = list(collocations.chunks([b"other"] * 37 + words))
    assert len(set(moved) & set(parts)) >= len(set(parts)) - 2
    assert max(len(c.split()) for c, _ in collocations.chunks([b"same"] * 5000)) <= collocations.MOST_WORDS + 4


def test_products_beyond_64_bits(spark):
    phrases = spark.createDataFrame([("en", "a b", 2, 3 * 10**14)], "lang string, phrase string, words int, a bigint")
    words = spark.createDataFrame([("en", "a", 4 * 10**14), ("en", "b", 5 * 10**14 + 7)], "lang string, phrase string, a bigint")
    totals = spark.createDataFrame([("en", 9 * 10**17)], "lang string, n bigint")
    row = collocations._scored(phrases, words, totals).first()
    assert row["score"] == 1000 * 3 * 10**14 * 9 * 10**17 // (4 * 10**14 * (5 * 10**14 + 7))


def test_empty_table(spark):
    assert collocations.collocations(table(spark, [])).count() == 0


def test_rows_sent_grow_with_the_input(spark, monkeypatch):
    """Five times the text gives about five times the rows at each step, though more phrases are frequent in it."""
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice("opqrstuvwxyz") for _ in range(60)), "a") for i in range(250)]
    frame, sent = type(spark.range(1)), []
    plain = frame.mapInArrow

    def counted(self, func, schema, *args, **kwargs):
        out = plain(self, func, schema, *args, **kwargs)
        sent.append(out.count())
        return out

    monkeypatch.setattr(frame, "mapInArrow", counted)
    for some in (rows[:50], rows):
        sent.append([])
        got = collocations.collocations(with_langs(spark, some), least=40)
        assert sorted(map(tuple, got.collect())) == phrases_by_hand(of(some), 40)
    cut = len(sent) // 2
    small, large = sent[1:cut], sent[cut + 1:]
    assert len(small) == len(large) > 2
    assert all(b <= 6 * a for a, b in zip(small, large) if b > 1000)


@pytest.mark.parametrize("name, most", [("HEAVY_WINDOWS", 5), ("BLOCK_BYTES", 400), ("SAMPLED", 10)])
def test_pairs_in_many_windows_and_tasks_in_many_blocks(spark, monkeypatch, name, most):
    monkeypatch.setattr(collocations, "HEAVY_WINDOWS", 1000)
    monkeypatch.setattr(collocations, "PART_WINDOWS", 200)
    monkeypatch.setattr(collocations, name, most)
    rows = wordy_rows()
    got = collocations.collocations(with_langs(spark, rows), least=3)
    assert sorted(map(tuple, got.collect())) == phrases_by_hand(of(rows), 3)


@pytest.mark.parametrize("numbers", [1, 7, (1 << 21) - 1, 1 << 21, (1 << 31) - 1])
def test_windows_keep_their_words(spark, numbers):
    form = collocations.Windows(numbers)
    words = [numbers, 1, max(1, numbers // 2), numbers, 0]
    keys = form.packed([np.array([w], np.int64) for w in words])
    row = spark.createDataFrame([tuple(int(k[0]) for k in keys)], ", ".join(f"{k} bigint" for k in collocations.KEYS))
    read = row.select(*[form.word(i) for i in range(5)], form.pair()).first()
    assert list(read)[:5] == words
    assert read[5] == int(keys[0][0]) >> form.at(1)[1] and int(keys[0][0]) >= 0
    assert [int(k[0]) & m for k, m in zip(keys, form.masks(2))] == [int(k[0]) for k in form.packed([np.array([w], np.int64) for w in [*words[:2], 0, 0, 0]])]
