"""Lines that many documents share, dropped by way of a sharded minimal perfect hash.

Distinct line hashes are counted by document. Each shard of them becomes a minimal perfect
hash with compact arrays beside it: fingerprint, number of documents, and the document
that keeps the line. Documents send only hashes; they are streamed past the arrays
of their shard, and what comes back is the hashes to drop.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridgale.llm import perfect_hash
from gridgale.llm.common import SPACES, lower_ascii, written

MIN_CHARS = 40
MIN_DOCUMENTS = 5
SHARD_KEYS = 1 << 16
TASK_PROBES = 200_000
INDEX = (
    "shard int, sizes array<bigint>, bits binary, prints binary, counts binary, keepers binary"
)


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def _hashes(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2"))


def line_hashes(docs: DataFrame, text: str, key: str, min_chars: int) -> DataFrame:
    """(`h1`, `h2`, `doc`) for each line key that is long enough, once per row."""
    keys = F.transform(split_lines(F.col(f"`{text}`")), line_key)
    long_keys = F.array_distinct(F.filter(keys, lambda k: F.length(k) >= min_chars))
    return docs.select(F.col(f"`{key}`").alias("doc"), F.explode(long_keys).alias("line")).select(
        _hashes(F.col("line")).alias("h"), "doc"
    ).select("h.h1", "h.h2", "doc")


def build_index(held: DataFrame, least: int) -> tuple[DataFrame, int]:
    """The shards' arrays, over the lines of `least` documents or more, and how many shards.

    A line is counted once for each document id; null is one id, and never keeps a line.
    Both groupings combine before they shuffle, so a line that fills a third of the rows
    weighs no more than any other.
    """
    per_line = held.distinct().groupBy("h1", "h2").agg(
        F.count("*").alias("n"), F.max("doc").alias("keeper")
    )
    counts = written(per_line.where(F.col("n") >= least), "line-counts")
    shards = max(1, -(-counts.count() // SHARD_KEYS))

    def shard(keys: pa.Table) -> pa.Table:
        h1, h2 = (keys[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
        sizes, bits = perfect_hash.build(h1, h2)
        order = np.argsort(perfect_hash.Index(sizes, bits, h1).locate(h1, h2))
        return pa.table({
            "shard": pa.array([keys["shard"][0].as_py()], pa.int32()),
            "sizes": pa.array([sizes], pa.list_(pa.int64())),
            "bits": [np.packbits(bits).tobytes()],
            "prints": [perfect_hash.fingerprint(h1, h2)[order].tobytes()],
            "counts": [keys["n"].to_numpy()[order].astype(np.int64).tobytes()],
            "keepers": [keys["keeper"].to_numpy()[order].astype(np.int64).tobytes()],
        })

    sharded = counts.withColumn("shard", _shard(shards))
    return sharded.groupBy("shard").applyInArrow(shard, INDEX), shards


def _shard(shards: int) -> Column:
    return F.pmod(F.shiftright("h1", 7), F.lit(shards)).cast("int")


def _probe(min_documents: int):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Streams sorted rows: a shard's arrays, then the hashes that ask them."""
        shard, index = None, None
        for batch in batches:
            arrays = batch["sizes"]
            shards = batch["shard"].to_numpy()
            starts = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1]]) if len(shards) else []
            cuts = np.union1d(starts, np.flatnonzero(arrays.is_valid().to_numpy(zero_copy_only=False)))
            for begin, end in zip(cuts, [*cuts[1:], len(shards)]):
                part = batch.slice(begin, end - begin)
                if part["sizes"][0].is_valid:
                    first = part.slice(0, 1).to_pylist()[0]
                    sizes = first["sizes"]
                    index = perfect_hash.Index(
                        sizes, np.unpackbits(np.frombuffer(first["bits"], np.uint8), count=sum(sizes)).astype(bool),
                        *[np.frombuffer(first[c], t) for c, t in (("prints", np.uint64), ("counts", np.int64), ("keepers", np.int64))],
                    )
                    shard, part = first["shard"], part.slice(1)
                if not len(part) or part["shard"][0].as_py() != shard:
                    continue  # no line of this shard is shared
                h1, h2 = (part[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
                at = index.find(h1, h2)
                counts, keepers = index.values
                missing = part["doc"].is_null().to_numpy(zero_copy_only=False)
                docs = part["doc"].fill_null(0).to_numpy()
                drop = (at >= 0) & (counts[at] >= min_documents) & (missing | (keepers[at] != docs))
                out = part.filter(pa.array(drop)).select(["doc", "h1"])
                if len(out):
                    yield out

    return probe


def lines_to_drop(held: DataFrame, min_documents: int) -> DataFrame:
    """(`doc`, `drops`): the hashes of the lines that each document loses.

    Hashes meet the arrays by shard. A shard that many ask is dealt over as many tasks as
    its askers need, each with a copy of the arrays; a task holds one shard's arrays and
    streams the askers by.
    """
    index, shards = build_index(held, min(2, min_documents))
    asked = held.withColumn("shard", _shard(shards))
    loads = asked.groupBy("shard").agg(F.ceil(F.count("*") / TASK_PROBES).cast("int").alias("salts"))
    loads = written(loads, "line-loads")
    spread = F.pmod(F.xxhash64(F.lit("salt"), "doc", "h1"), "salts").cast("int")
    nothing = {c: F.lit(None) for c in ("h1", "h2", "doc")}
    copies = index.join(loads, "shard").select(
        "*", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        *[v.cast("bigint").alias(c) for c, v in nothing.items()],
    )
    askers = asked.join(loads, "shard").withColumn("salt", spread)
    arrays = [f.split()[0] for f in INDEX.split(", ")[1:]]
    both = copies.select("shard", "salt", *arrays, "h1", "h2", "doc").unionByName(
        askers.select("shard", "salt", "h1", "h2", "doc"), allowMissingColumns=True
    )
    met = both.repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("sizes").isNull())
    return met.mapInArrow(_probe(min_documents), "doc bigint, h1 bigint").groupBy("doc").agg(
        F.collect_set("h1").alias("drops")
    )


def _without(min_chars: int):
    """The texts without the lines whose hashes are listed; a line is looked up in a set, however many there are."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes, dropped = [], [], []
            for text, drops in zip(batch["text"].to_pylist(), batch["drops"]):
                lines = (text or "").split("\n")
                sizes.append(len(lines))
                kept = lines
                if drops.is_valid:
                    gone = set(drops.values.to_pylist())
                    kept = [x for x in lines if len(x) < min_chars or _key_hash(x, min_chars) not in gone]
                dropped.append(len(lines) - len(kept))
                texts.append("\n".join(kept))
            columns = [batch["row"], pa.array(sizes, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "n_lines", "n_dropped", "kept_text"])

    return work


def _key_hash(line: str, min_chars: int) -> int | None:
    """The hash of a line's key as `xxhash64` gives it; of keys that are too short, none."""
    key = line.strip(SPACES)
    if len(key) < min_chars:
        return None
    h = xxhash.xxh64_intdigest(key.encode().lower(), 42)  # of bytes, lower() takes A to Z alone
    return h - (1 << 64) if h >> 63 else h


def drop_repeated_lines(
    docs: DataFrame, carry: list[str] | None = None, text: str = "text", key: str = "doc_id",
    min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """`row` (the columns `carry`, by default all) with `n_lines`, `n_dropped` and `kept_text`.

    A line is known by its text without white space at the ends and with A-Z lowered. Lines of
    `min_chars` code points or more that stand in `min_documents` documents or more go,
    except in the document with the largest id. A null or empty text is one empty
    line, and its kept text is empty. Rows that repeat an id are one document: they share
    what they lose. A null id counts as one document and never keeps a line. Ids are
    whole numbers. An empty table stays empty. Lines are compared by two 64-bit hashes.
    """
    held = written(line_hashes(docs, text, key, min_chars), "lines")
    drops = lines_to_drop(held, min_documents)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (carry or docs.columns)]).alias("row"),
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"),
    )
    joined = rows.join(drops, F.col("key").eqNullSafe(F.col("doc")), "left").select("row", "text", "drops")
    kind = rows.schema["row"].dataType.simpleString()
    return joined.mapInArrow(_without(min_chars), f"row {kind}, n_lines bigint, n_dropped bigint, kept_text string")
