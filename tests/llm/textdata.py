"""Small document tables with everything in them that a column may hold."""

from __future__ import annotations

import random

from pyspark.sql import types as T

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "row", "id", "key", "size", "shard", "n_lines", "score", "hash", "taken", "start"]
SCHEMA = T.StructType([
    T.StructField(c, T.LongType() if c in ("doc_id", "n_chars") else T.StringType()) for c in COLUMNS
])


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    out = []
    for i in range(words):
        out.append("".join(rng.choice("abcdefghilmnoprstuv") for _ in range(rng.randint(2, 9))))
        if i % 9 == 8:
            out[-1] += rng.choice([".", ".\n", ","])
    return " ".join(out)


def table(spark, rows):
    """(doc_id, text, source) as documents, with more columns whose names operators use themselves."""
    return spark.createDataFrame(
        [(d, t, "en", s, None if t is None else len(t), *["x"] * 10) for d, t, s in rows], SCHEMA
    )


def odd_rows():
    """Nulls, empty, blank and very long texts, ties and repeated rows."""
    shared = "A line that very many of the documents here will hold as theirs."
    long = "\n".join(prose(i, 40) for i in range(120)) + "\n" + "word " * 3000
    near = prose(1, 200)
    return [
        (1, None, "a"), (2, "", "a"), (3, " \t\n\x0b\f\r ", None), (4, "one", "b"), (5, "one two three four", "b"),
        (5, "one two three four", "b"), (6, long, "a"), (7, near, "a"), (8, near, "a"), (9, near + " more", None),
        (10, near.replace(" ", "  ", 3), "c"), (None, near, "c"), (None, None, None), (12, prose(12, 30) + "\n" + shared, "a"),
        *[(20 + i, f"{prose(40 + i, 25)}\n  {shared.upper() if i % 2 else shared} \n{prose(90 + i, 12)}", "ab"[i % 2]) for i in range(6)],
        (30, f"{shared}\n{shared}", "a"), (30, shared, "z"), (31, "é ñ 日本語 😀 naïve Σας", "z"), (None, shared, "z"),
        (32, 'token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"\nReleased under the MIT License.', "z"),
    ]
