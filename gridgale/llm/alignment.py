"""Alignment of two tokenizers' tokens: which of them cover the same bytes.

Both tokenizers cut a text into tokens that tile its bytes. A token's start is looked up among
the other side's starts with `pandas.merge_asof`, keyed by document: the last one at or before it
belongs to the token that covers it. Two tokens overlap exactly when one of them starts
inside the other, so both directions together give all overlaps, each once. Where tokens of
both sides end at the same byte, a group ends.

How often two ids overlap in the whole corpus is counted by blocks of documents: a block lists
its different id pairs once, the totals of all blocks come back to it, and its documents, which
keep their pairs as places in the block's list, add them up.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridgale.llm.common import written

BYTE_RANKS = "byte_bpe_50k.tiktoken"  # the vocabulary of byte_bpe_50k.json as ranks
PIECES = "piece_bpe_32k.model"
BLOCK_BYTES = 2 << 20
SHIFT = 32  # a pair is (a << SHIFT) | b
REMEMBERED = 200_000  # segments of texts whose ids a task keeps
# Visible characters below U+0250, which are white space for neither tokenizer.
PLAIN_BLANK = re.compile("(?<=[!-~À-ɏ]) (?=[!-~À-ɏ])")

Encoder = Callable[[list[str]], list[list[int]]]


def _path(name: str) -> str:
    """A file's place; the names above are looked up among the public tokenizers."""
    if name in (BYTE_RANKS, PIECES):
        import public_tokenizers

        return public_tokenizers.path(name)
    return name


def byte_tokens(path: str = BYTE_RANKS) -> tuple[Encoder, list[bytes]]:
    """Encoder of byte-level BPE, which gets space+text, and the bytes of each id."""
    import public_tokenizers
    import tiktoken

    with open(_path(path), "rb") as lines:
        ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)}
    tokenizer = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    known = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        known[i] = token
    return lambda texts: [tokenizer.encode_ordinary(" " + t) for t in texts], known


def piece_tokens(path: str = PIECES) -> tuple[Encoder, list[bytes]]:
    """Encoder of sentence pieces, which puts the space before a text itself, and the bytes of each id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=_path(path))

    def of(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    return lambda texts: model.encode(texts, num_threads=1), [of(i) for i in range(model.get_piece_size())]


class Encoders:
    """Both tokenizers, fed with segments of texts that are remembered.

    Where one blank stands between two plain characters, both sides begin a token with the blank, and what
    comes before has no say in what follows: byte-level BPE cuts there before it merges, and no
    sentence piece has a blank after another character. So a segment between such blanks is
    encoded once. With pieces of another kind a text is one segment.
    """

    def __init__(self, a_path: str, b_path: str):
        (self.encode_a, self.known_a), (self.encode_b, self.known_b) = byte_tokens(a_path), piece_tokens(b_path)
        self.apart = not any(b" " in piece.lstrip(b" ") for piece in self.known_b)
        self.lengths = [np.array([len(t) for t in known], np.int64) for known in (self.known_a, self.known_b)]
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}  # of a segment
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]  # of all segments in turn, for each side
        self.sizes = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.tiled = np.zeros(0, bool)  # whether a segment's tokens are blank+segment on both sides

    def _encode(self, segments: list[str]) -> None:
        given = [b" " + s.encode() for s in segments]
        length = np.fromiter(map(len, given), np.int64, len(given))
        tiled = np.ones(len(given), bool)
        for side, (encode, known) in enumerate(((self.encode_a, self.known_a), (self.encode_b, self.known_b))):
            found = encode(segments)
            size = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter(chain.from_iterable(found), np.int32, int(size.sum()))
            of = np.repeat(np.arange(len(size)), size)
            tiled &= np.bincount(of, self.lengths[side][ids], len(size)).astype(np.int64) == length
            if b"".join([known[i] for i in ids.tolist()]) != b"".join(given):
                tiled &= [b"".join([known[i] for i in one]) == g for one, g in zip(found, given)]
            self.ids[side] = np.concatenate([self.ids[side], ids])
            self.sizes[side] = np.concatenate([self.sizes[side], size])
        self.number.update(zip(segments, range(len(self.number), len(self.number) + len(segments))))
        self.tiled = np.concatenate([self.tiled, tiled])

    def sides(self, texts: list[str | None]) -> tuple[Side, Side]:
        """The tokens of all texts; none for those without text or with other bytes than space+text."""
        parts = [(PLAIN_BLANK.split(t) if self.apart else [t]) if t else [] for t in texts]
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        coded = pa.array(list(chain.from_iterable(parts)), pa.large_string()).dictionary_encode()
        segments = coded.dictionary.to_pylist()
        if len(self.number) > REMEMBERED:
            self.forget()
        new = [s for s in segments if s not in self.number]
        if new:
            self._encode(new)
        numbers = np.fromiter(map(self.number.__getitem__, segments), np.int64, len(segments))
        order = numbers[coded.indices.to_numpy()]
        doc = np.repeat(np.arange(len(texts)), counts)
        untiled = ~self.tiled[order]
        if untiled.any():
            keep = ~np.isin(doc, doc[untiled])
            order, doc = order[keep], doc[keep]
        return tuple(Side(self.ids[s], self.sizes[s], order, doc, len(texts), self.lengths[s]) for s in (0, 1))


class Side:
    """The tokens of one tokenizer over the joined bytes of several documents.

    `flat` are the ids of numbered segments in turn, `size` how many each has, `order` which segments
    follow each other, `doc` whose they are.
    """

    def __init__(self, flat: np.ndarray, size: np.ndarray, order: np.ndarray, doc: np.ndarray, docs: int, lengths: np.ndarray):
        n = size[order]
        stops = np.cumsum(n)
        at = np.repeat((np.cumsum(size) - size)[order] - (stops - n), n) + np.arange(int(n.sum()))
        self.ids = flat[at].astype(np.int64)
        self.doc = np.repeat(doc, n)
        self.counts = np.bincount(self.doc, minlength=docs)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.end = np.cumsum(lengths[self.ids])
        self.start = self.end - lengths[self.ids]

    def __len__(self) -> int:
        return len(self.ids)

    def starts(self, chosen: np.ndarray | slice = slice(None)) -> pd.DataFrame:
        return pd.DataFrame({"at": self.start[chosen], "doc": self.doc[chosen], "token": np.arange(len(self))[chosen]})


def _covering(tokens: pd.DataFrame, other: Side) -> np.ndarray:
    """The token of the other side that covers each token's start."""
    return pd.merge_asof(tokens[["at", "doc"]], other.starts(), on="at", by="doc")["token"].to_numpy(np.int64)


def align(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All overlaps as (token of A, token of B), and whether each token of A and B begins a group."""
    over_a = _covering(a.starts(), b)
    begins_a = b.start[over_a] == a.start
    begins_b = np.zeros(len(b), bool)
    begins_b[over_a[begins_a]] = True
    # A token of B that starts with one of A has met it already.
    rest = np.flatnonzero(~begins_b)
    over_b = _covering(b.starts(rest), a)
    return np.concatenate([np.arange(len(a)), over_b]), np.concatenate([over_a, rest]), begins_a, begins_b


def _number_texts(size: int) -> np.ndarray:
    """Two texts for each id: with a comma after it, and, `size` places on, with what ends its side's part."""
    return np.array([b"%d," % i for i in range(size)] * 2, dtype=object)


class GroupTexts:
    """Groups of documents as `a1,a2|b1;a3|b2,b3`, put together from the texts of ids."""

    def __init__(self, size_a: int, size_b: int):
        self.size_a, self.a = size_a, _number_texts(size_a)
        self.size_b, self.b = size_b, _number_texts(size_b)
        self.a[size_a:] = [b"%d|" % i for i in range(size_a)]
        self.b[size_b:] = [b"%d;" % i for i in range(size_b)]

    def digests(self, a: Side, b: Side, begins_a: np.ndarray, begins_b: np.ndarray) -> list[str]:
        group_a, group_b = np.cumsum(begins_a) - 1, np.cumsum(begins_b) - 1
        first_a = np.append(np.flatnonzero(begins_a), len(a))
        first_b = np.append(np.flatnonzero(begins_b), len(b))
        last_a, last_b = np.append(begins_a[1:], True), np.append(begins_b[1:], True)
        parts = np.empty(len(a) + len(b), dtype=object)
        # Before a token of A stand the tokens of B of earlier groups; before one of B, those of A of its own group too.
        parts[np.arange(len(a)) + first_b[group_a]] = self.a[a.ids + self.size_a * last_a]
        parts[np.arange(len(b)) + first_a[group_b + 1]] = self.b[b.ids + self.size_b * last_b]
        whole, ends = parts.tolist(), a.first + b.first
        return [
            hashlib.sha256(b"".join(whole[x:y])[:-1]).hexdigest() if y > x else ""
            for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())
        ]


def _slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    weight = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False))
    cuts = np.searchsorted(weight, np.arange(most, int(weight[-1]) if len(weight) else 0, most))
    for x, y in zip([0, *cuts], [*cuts, len(batch)]):
        if x < y:
            yield batch.slice(x, y - x)


def _aligned(a_path: str, b_path: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = Encoders(a_path, b_path)
        texts_of = GroupTexts(len(encoders.known_a), len(encoders.known_b))
        block = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in _slices(whole, BLOCK_BYTES):
                texts = batch["text"].to_pylist()
                a, b = encoders.sides(texts)
                link_a, link_b, begins_a, begins_b = align(a, b)
                doc = a.doc[link_a]

                pair = (a.ids[link_a] << SHIFT) | b.ids[link_b]
                pairs, place = np.unique(pair, return_inverse=True)
                of_doc, n = np.unique((doc << SHIFT) | place, return_counts=True)
                place, bounds = of_doc & ((1 << SHIFT) - 1), np.searchsorted(of_doc >> SHIFT, np.arange(len(texts) + 1))
                totals = np.bincount(place, n, len(pairs)).astype(np.int64)
                kept = [
                    zlib.compress(np.concatenate([np.diff(place[x:y], prepend=0), n[x:y]]).astype("<i4").tobytes(), 1)
                    for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())
                ]
                first = [True] + [False] * (len(texts) - 1)
                columns = {
                    "row": batch["row"],
                    "n_a": pa.array(a.counts), "n_b": pa.array(b.counts),
                    "n_groups": pa.array(np.bincount(a.doc[begins_a], minlength=len(texts))),
                    "n_links": pa.array(np.bincount(doc, minlength=len(texts))),
                    "groups_sha256": pa.array(texts_of.digests(a, b, begins_a, begins_b), pa.string()),
                    "block": pa.array(np.full(len(texts), block)),
                    "kept": pa.array(kept, pa.binary()),
                    "pairs": pa.array([pairs.astype("<i8").tobytes() if x else None for x in first], pa.binary()),
                    "totals": pa.array([totals.astype("<i8").tobytes() if x else None for x in first], pa.binary()),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
                block += 1

    return work


LISTED = "block bigint, place int, pair bigint, n bigint"


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's list of pairs as rows."""
    for batch in batches:
        for block, pairs, totals in zip(*(batch[c].to_pylist() for c in ("block", "pairs", "totals"))):
            pairs = np.frombuffer(pairs, "<i8")
            columns = [np.full(len(pairs), block), np.arange(len(pairs), dtype=np.int32), pairs, np.frombuffer(totals, "<i8")]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["block", "place", "pair", "n"])


def _summed(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """The counts of a block's pairs, added up by its documents."""
    size = len(counts)
    total, best = np.zeros(size, np.int64), np.zeros(size, bool)
    place = counts["place"].to_numpy()
    total[place], best[place] = counts["total"].to_numpy(), counts["best"].to_numpy()
    n_best, count_sum = [], []
    for kept in docs["kept"].to_pylist():
        places, n = np.frombuffer(zlib.decompress(kept), "<i4").astype(np.int64).reshape(2, -1)
        places = np.cumsum(places)
        n_best.append(int(n[best[places]].sum()))
        count_sum.append(int((n * total[places]).sum()))
    out = docs.drop_columns(["block", "kept"])
    return out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))


def align_documents(
    docs: DataFrame, carry: list[str] | None = None, text: str = "text", byte_ranks: str = BYTE_RANKS, pieces: str = PIECES
) -> DataFrame:
    """`row` (the columns `carry`, by default all) with `n_a`, `n_b`, `n_groups`, `n_links`, `groups_sha256`,
    `n_best` and `count_sum`, one row a document.

    A is byte-level BPE over space+text, B sentence pieces over the text. A text that is null or empty,
    or whose tokens' bytes are not space+text, has no tokens: all zero, and '' as digest. Special
    tokens' strings are plain text. Rows that repeat count each. An empty table gives no row. Ids
    with equally many links tie, and all of them are best.

    Documents are worked through in blocks of some megabytes; a very long text is a block of its own.
    What crosses the network is a row for each different pair of a block, however often the pair is there, and
    one row for each document.
    """
    body = F.col(f"`{text}`").alias("text")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in (carry or docs.columns)]).alias("row"), body)
    kind = rows.schema["row"].dataType.simpleString()
    figures = f"row {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
    aligned = written(
        rows.mapInArrow(
            _aligned(byte_ranks, pieces), f"{figures}, block bigint, kept binary, pairs binary, totals binary"
        ),
        "aligned",
    )
    listed = aligned.where(F.col("pairs").isNotNull()).select("block", "pairs", "totals").mapInArrow(_listed, LISTED)
    counts = written(listed.groupBy("pair").agg(F.sum("n").alias("total")), "pair-counts")
    b = F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1))
    most = counts.groupBy(b.alias("b")).agg(F.max("total").alias("most"))
    ranked = counts.withColumn("b", b).join(most, "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    answers = listed.select("block", "place", "pair").join(ranked, "pair").select("block", "place", "total", "best")
    return (
        aligned.drop("pairs", "totals").groupBy("block").cogroup(answers.groupBy("block"))
        .applyInArrow(_summed, f"{figures}, n_best bigint, count_sum bigint")
    )
