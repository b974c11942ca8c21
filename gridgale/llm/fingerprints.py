"""Fingerprints of documents by invertible Bloom lookup sketches of their paragraphs."""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridgale.llm import sketches
from gridgale.llm.common import mix64

WIDTH = 5  # cells in each of the three tables of a fingerprint
PIECE = 32  # code points of a paragraph that make one digest at most
PIECES = re.compile(rf"[^.\n]{{1,{PIECE}}}[.\n]?|[.\n]")
BUCKET_ROWS = 4096
MOST_BUCKETS = 20_000
BATCH_BYTES = 1 << 19  # of compressed texts


def digests(text: str) -> np.ndarray:
    """A digest for each piece of the paragraphs; a piece that comes again has another one."""
    found = PIECES.findall(text)
    h = np.fromiter((xxhash.xxh64_intdigest(p) for p in found), np.uint64, len(found))
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    first = np.ones(len(h), bool)
    first[1:] = ranked[1:] != ranked[:-1]
    begin = np.flatnonzero(first)
    again = np.arange(len(h)) - np.repeat(begin, np.diff(np.append(begin, len(h))))
    return mix64(ranked + again.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def fingerprints(sets: list[np.ndarray], width: int = WIDTH) -> list[str]:
    """Each set's size and cells as text. Equal texts have equal fingerprints."""
    cells = sketches.empty(len(sets), width)
    n = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    sketches.add(*cells, np.repeat(np.arange(len(sets)), n), flat, np.ones(len(flat), np.int64), width)
    counts, sums, marks = (c.reshape(len(sets), -1) for c in cells)
    packed = [
        struct.pack("<q", n[i]) + counts[i].astype("<i4").tobytes() + sums[i].tobytes() + marks[i].astype("<u4").tobytes()
        for i in range(len(sets))
    ]
    return [base64.b64encode(p).decode() for p in packed]


def likeness(one: np.ndarray, two: np.ndarray, difference: tuple[np.ndarray, np.ndarray]) -> float:
    """The share of both sets' digests that the other has as well; of two empty sets, 1."""
    whole = len(one) + len(two)
    return 1.0 - (len(difference[0]) + len(difference[1])) / whole if whole else 1.0


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the beginning of another one."""
    part = len(text) // 3
    return text[: len(text) - part] + following[:part]


def with_next(docs: DataFrame, carry: list[str], text: str, key: str) -> DataFrame:
    """`row`, `packed` (the compressed text), `place` and `following`, in runs by descending key.

    Keys are dealt into ranges at their quantiles, and a range's rows are numbered from 1 in
    order. The next document is the row that follows, so its text is not carried twice;
    only the last row of a range has one in `following`: the first text of the range below,
    and of the last range the first text of all. Only the quantiles come to the driver.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{key}`").alias("id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("tie", F.md5(F.col("text").cast("binary")))
    buckets = min(MOST_BUCKETS, max(1, docs.count() // BUCKET_ROWS))
    steps = [i / buckets for i in range(1, buckets)]
    cuts = rows.select(F.percentile_approx("id", steps or [0.5], max(10_000, 20 * buckets))).first()[0] if steps else []
    bounds = np.unique(np.array(cuts if cuts is not None else [], np.int64))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row's range, and its text in the short form in which it is shuffled. Null keys come
        last and have a range of their own."""
        compress = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            ids = batch["id"].fill_null(0).to_numpy()
            bucket = np.where(batch["id"].is_null().to_numpy(zero_copy_only=False), -1, np.searchsorted(bounds, ids))
            short = pa.array([compress(t.as_buffer()) for t in batch["text"]], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["id"], batch["tie"], pa.array(bucket.astype(np.int32)), short],
                names=["row", "id", "tie", "bucket", "packed"],
            )

    kind = rows.schema["row"].dataType.simpleString()
    dealt = rows.select("row", "id", "tie", "text").mapInArrow(
        deal, f"row {kind}, id bigint, tie string, bucket int, packed binary"
    )
    inside = Window.partitionBy("bucket").orderBy(F.col("id").desc_nulls_last(), F.col("tie").desc())
    led = dealt.select("*", F.row_number().over(inside).alias("place"), F.lead(F.lit(1)).over(inside).alias("after"))
    # Each range's first row, found by its key before any text is looked at.
    tops = rows.groupBy(_range_column(bounds).alias("bucket")).agg(F.max("id").alias("top"))
    below = Window.orderBy(F.col("bucket").desc())
    everything = below.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chain = tops.select(
        "bucket", F.coalesce(F.lead("bucket").over(below), F.first("bucket").over(everything)).alias("next_bucket")
    )
    firsts = (
        rows.join(F.broadcast(tops), F.col("id").eqNullSafe(F.col("top")))  # MOST_BUCKETS + 1 rows at most
        .groupBy("bucket").agg(F.max_by("text", "tie").alias("first_text"))
    )
    borders = chain.join(firsts.withColumnRenamed("bucket", "next_bucket"), "next_bucket").select(
        F.col("bucket").alias("_bucket"), "first_text"
    )
    joined = led.join(borders, (F.col("bucket") == F.col("_bucket")) & F.col("after").isNull(), "left")
    return joined.select("row", "packed", "place", F.col("first_text").alias("following"))


def _range_column(bounds: np.ndarray) -> Column:
    """The range of `id` as `deal` gives it, for plans that need no texts."""
    @F.pandas_udf("int")
    def range_of(ids):
        return type(ids)(np.searchsorted(bounds, ids.to_numpy(np.int64)))

    return F.when(F.col("id").isNull(), F.lit(-1)).otherwise(range_of(F.coalesce("id", F.lit(0))))


def compare_versions(docs: DataFrame, carry: list[str] | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """`row` (the columns `carry`, by default all) with `n_chars`, `edited_text`, `fingerprint`,
    `edited_fingerprint`, `near_edited`, `near_next`, and `lost` and `gained`, the digests that the
    edit took away and brought.

    A null text is empty; an empty text's edit is empty, its fingerprint has no digests, and two
    empty texts are alike. Rows that repeat a key follow each other by the MD5 of their texts,
    descending. Null keys come after all others. A document alone is its own next. An empty table stays
    empty. Keys are whole numbers.
    """
    carry = carry or docs.columns
    rows = with_next(docs, carry, text, key)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        held = None  # a row whose next one is still to come
        for batch in batches:
            weight = np.cumsum(pc.binary_length(batch["packed"]).to_numpy())
            cuts = np.unique(np.searchsorted(weight, np.arange(BATCH_BYTES, weight[-1] if len(weight) else 0, BATCH_BYTES)))
            for a, b in zip([0, *cuts], [*cuts, len(batch)]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if held is not None:
                    part = pa.concat_batches([held, part])
                texts = [expand(t.as_buffer()).decode() for t in part["packed"]]
                after, place = (part[c].to_pylist() for c in ("following", "place"))
                n = len(texts) - (after[-1] is None)
                if any(after[i] is None and place[i + 1] != place[i] + 1 for i in range(n)):
                    raise RuntimeError("rows do not come in their order")
                if n:
                    following = [texts[i + 1] if after[i] is None else after[i] for i in range(n)]
                    yield compared(part["row"].slice(0, n), texts[:n], following)
                held = part.slice(n) if n < len(texts) else None
        if held is not None:
            raise RuntimeError("a row without a next one")

    def compared(kept: pa.Array, texts: list[str], following: list[str]) -> pa.RecordBatch:
        changed = [edited(t, f) for t, f in zip(texts, following)]
        own, new = [digests(t) for t in texts], [digests(t) for t in changed]
        after = [
            own[i + 1] if i + 1 < len(texts) and f == texts[i + 1] else digests(f) for i, f in enumerate(following)
        ]
        edits = sketches.differences(own, new, WIDTH)
        nexts = sketches.differences(own, after, WIDTH)
        columns = {
            "row": kept, "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            "edited_text": pa.array(changed), "fingerprint": pa.array(fingerprints(own)),
            "edited_fingerprint": pa.array(fingerprints(new)),
            "near_edited": pa.array([likeness(*x) for x in zip(own, new, edits)], pa.float64()),
            "near_next": pa.array([likeness(*x) for x in zip(own, after, nexts)], pa.float64()),
            "lost": pa.array([d[0].view(np.int64) for d in edits], pa.list_(pa.int64())),
            "gained": pa.array([d[1].view(np.int64) for d in edits], pa.list_(pa.int64())),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(
        work,
        f"row {kind}, n_chars bigint, edited_text string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double, lost array<bigint>, gained array<bigint>",
    )
