"""Near duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A document's set of word shingles becomes a signature of POSITIONS values of 16 bits, four to a long.
Two signatures within DISTANCE different positions have, by the pigeonhole principle, a
long in which one position differs at most. So each long is looked up four times, with each
of its positions left out in turn; equal keys make candidates, the Hamming distance sorts
them, and the full sets confirm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridgale.llm.common import lower_ascii, mix64, word_hashes, written
from gridgale.operators.components import components

SHINGLE = 5
NUMERATOR, DENOMINATOR = 75, 100
CHUNKS = 20  # longs in a signature
POSITIONS = 4 * CHUNKS
# One error in one of 20 longs at most, or more than 39 errors: a pair of similarity 0.75 has
# more than that (mean 20, deviation 3.9) about once in a million, of 0.8 once in 10^10.
DISTANCE = 2 * CHUNKS - 1
BATCH_WORDS = 1 << 20
BROADCAST_ROWS = 1_000_000
BLOCK = 512  # rows of a group that meet in one task
FIELD = 0xFFFF
SIGN = [f"sign{c}" for c in range(CHUNKS)]


def _runs(values: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """A list column as its flat values and where each row begins, with the end."""
    offsets = values.offsets.to_numpy()
    return values.values.to_numpy()[offsets[0]:offsets[-1]].view(np.uint64), (offsets - offsets[0]).astype(np.int64)


def shingle_sets(hashes: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Each row's distinct shingles, sorted, from the hashes of its words.

    A row with fewer words than a shingle has its whole sequence as one; a row without
    words has none.
    """
    size = len(hashes)
    rolled = np.zeros(size, np.uint64)
    if size >= SHINGLE:
        for i in range(SHINGLE):
            rolled[: size - SHINGLE + 1] = mix64(rolled[: size - SHINGLE + 1] + hashes[i : size - SHINGLE + 1 + i])
    out = []
    for a, b in zip(starts[:-1], starts[1:]):
        if b - a >= SHINGLE:
            out.append(np.unique(rolled[a : b - SHINGLE + 1]))
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for h in hashes[a:b]:
                whole = mix64(whole + h)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """CHUNKS longs for each set that is not empty."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    seeds = mix64(np.arange(1, 2 * POSITIONS + 1, dtype=np.uint64))
    out = np.zeros((len(sets), CHUNKS), np.uint64)
    for i in range(POSITIONS):
        drawn = (flat ^ seeds[i]) * (seeds[POSITIONS + i] | np.uint64(1))
        drawn ^= drawn >> np.uint64(29)
        low = mix64(np.minimum.reduceat(drawn, starts)) & np.uint64(FIELD)
        out[:, i // 4] |= low << np.uint64(16 * (i % 4))
    return out


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of a bounded number of words, one row at least."""
    ends = batch["hashes"].offsets.to_numpy()
    begin = 0
    while begin < len(batch):
        end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + BATCH_WORDS)) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in _pieces(whole):
            sets = shingle_sets(*_runs(batch["hashes"]))
            full = [s for s in sets if len(s)]
            some = np.array([len(s) > 0 for s in sets])
            signs = np.zeros((len(sets), CHUNKS), np.uint64)
            if full:
                signs[some] = signatures(full)
            ids = np.array([(mix64(s).sum(dtype=np.uint64), mix64(~s).sum(dtype=np.uint64)) for s in sets], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"], pa.array([len(s) for s in sets], pa.int64()),
                    *[pa.array(ids[:, i].copy().view(np.int64)) for i in (0, 1)],
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(0, signs.size + 1, CHUNKS, dtype=np.int32)), pa.array(signs.ravel().view(np.int64))
                    ),
                ],
                names=["id", "n", "s1", "s2", "sign"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in _pieces(whole):
            sets = [s.tobytes() for s in shingle_sets(*_runs(batch["hashes"]))]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(sets, pa.binary())], names=["id", "items"])


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """The runs of rows with equal columns `by`, also where a run goes over several batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        marks = np.stack([batch[c].to_numpy() for c in by])
        cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1), len(batch)]
        for begin, end in zip(cuts[:-1], cuts[1:]):
            part = batch.slice(begin, end - begin)
            if held and any(held[0][c][0] != part[c][0] for c in by):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In each block of a key: the ids that are near one another, each with those it is to be compared with.

    Pairs of one component are left out, and a pair is taken only under the first of the
    keys that it shares.
    """
    for table in _groups(batches, ["pos", "key", "i", "j"]):
        pos, i, j = (table[c][0].as_py() for c in ("pos", "i", "j"))
        ids, roots, sizes, parts = (table[c].to_numpy() for c in ("id", "root", "n", "part"))
        signs = np.stack([table[c].to_numpy() for c in SIGN], axis=1).view(np.uint16).reshape(len(ids), POSITIONS)
        chunk, position = divmod(pos, 4)
        left = np.flatnonzero(parts == i)
        right = left if i == j else np.flatnonzero(parts == j)
        lists: dict[int, list[int]] = {}
        for begin in range(0, len(left), 64):
            some = left[begin : begin + 64]
            open_ = roots[some][:, None] != roots[right][None]
            if i == j:
                open_ &= some[:, None] < right[None]
            low, high = (f(sizes[some][:, None], sizes[right][None]) for f in (np.minimum, np.maximum))
            x, y = np.nonzero(open_ & (DENOMINATOR * low >= NUMERATOR * high))
            for k in range(0, len(x), 1 << 16):
                a, b = some[x[k : k + (1 << 16)]], right[y[k : k + (1 << 16)]]
                differ = (signs[a] != signs[b]).reshape(-1, CHUNKS, 4).sum(axis=2)
                here = differ[:, chunk]
                first = (differ[:, :chunk] > 1).all(axis=1) & ((here == 1) | ((here == 0) & (position == 0)))
                hit = first & (differ.sum(axis=1) <= DISTANCE)
                for p, q in zip(a[hit].tolist(), b[hit].tolist()):
                    lists.setdefault(p, []).append(int(ids[q]))
                    lists.setdefault(q, [])
        if lists:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_signed(hash((pos, table["key"][0].as_py(), i, j)) & ((1 << 64) - 1))] * len(lists), pa.int64()),
                    pa.array([int(ids[p]) for p in lists], pa.int64()), pa.array(list(lists.values()), pa.list_(pa.int64())),
                ],
                names=["g", "id", "others"],
            )


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In each group: compares the full sets of the listed pairs, and returns the links that connect
    what is connected; a link between rows that are connected already is not needed."""
    for table in _groups(batches, ["g"]):
        ids = table["id"].to_pylist()
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in table["items"]]
        ends = np.cumsum([0, *map(len, sets)])
        items, place = np.unique(np.concatenate(sets), return_inverse=True)
        rows_of: dict[int, list[int]] = {}
        for row, key in enumerate(ids):
            rows_of.setdefault(key, []).append(row)
        root = {key: key for key in rows_of}

        def find(key: int) -> int:
            while root[key] != key:
                root[key] = key = root[root[key]]
            return key

        links, mark = [], np.zeros(len(items), bool)
        for row, others in enumerate(table["others"].to_pylist()):
            if not others:
                continue
            own = place[ends[row] : ends[row + 1]]
            mark[own] = True
            for other in others:
                a, b = find(ids[row]), find(other)
                for r in rows_of.get(other, ()):
                    if a == b:
                        break
                    shared = int(np.count_nonzero(mark[place[ends[r] : ends[r + 1]]]))
                    if DENOMINATOR * shared >= NUMERATOR * (len(own) + len(sets[r]) - shared):
                        links.append((ids[row], other))
                        root[b] = a
                        break
            mark[own] = False
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["a", "b"])


def lookup_keys() -> Column:
    """Each long with each position left out; the free place says which."""
    keys = []
    for c, name in enumerate(SIGN):
        for j in range(4):
            rest = ((1 << 64) - 1) ^ (FIELD << (16 * j))
            keys.append(F.col(name).bitwiseAND(F.lit(_signed(rest))).bitwiseOR(F.lit(_signed((4 * c + j) << (16 * j)))))
    return F.array(*keys)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def distance(one: list[Column], two: list[Column]) -> Column:
    """In how many positions two signatures differ.

    A position's highest bit is set where it is not zero; half a long at a time, so that
    sums stay in range.
    """
    total = F.lit(0)
    for x, y in zip(one, two):
        differ = x.bitwiseXOR(y)
        for half in (differ.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(differ, 32)):
            marked = (half.bitwiseAND(F.lit(0x7FFF7FFF)) + F.lit(0x7FFF7FFF)).bitwiseOR(half)
            total = total + F.bit_count(marked.bitwiseAND(F.lit(0x80008000)))
    return total


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Ids that are few enough go to every task; more of them are shuffled."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _near_enough(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """The pairs whose sizes allow a link and whose signatures are near."""
    def side(name: str) -> DataFrame:
        return signs.select(F.col("id").alias(name), F.col("n").alias(f"n_{name}"), *[F.col(c).alias(f"{name}_{c}") for c in SIGN])

    def sign(name: str) -> list[Column]:
        return [F.col(f"{name}_{c}") for c in SIGN]

    return (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .where(DENOMINATOR * F.least("n_a", "n_b") >= NUMERATOR * F.greatest("n_a", "n_b"))
        .where(distance(sign("a"), sign("b")) <= DISTANCE)
        .select("a", "b").distinct()
    )


def _star_groups(stars: DataFrame) -> DataFrame:
    """(`g`, `id`, `others`) for pairs of a first id `a` and another one `b`; a first id with many
    others comes in as many groups."""
    counts = stars.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("salts"))
    dealt = stars.join(counts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), "salts"))
    firsts = counts.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    group = F.xxhash64("a", "salt").alias("g")
    return dealt.select(group, F.col("b").alias("id"), F.array("a").alias("others")).unionByName(
        firsts.select(group, F.col("a").alias("id"), F.array().cast("array<bigint>").alias("others"))
    )


def _linked(groups: DataFrame, texts: DataFrame) -> DataFrame:
    """The links (`a`, `b`) that hold the listed pairs of (`g`, `id`, `others`) together, by full sets."""
    involved = written(groups.select("id").distinct(), "near-ids")
    chosen = texts.join(_small(involved, involved.count()), "id", "left_semi")
    sets = written(
        chosen.select("id", word_hashes(lower_ascii(F.col("text"))).alias("hashes")).mapInArrow(_sets, "id bigint, items binary").distinct(),
        "near-sets",
    )
    met = groups.join(sets, "id").repartition("g").sortWithinPartitions("g")
    return written(met.select("g", "id", "others", "items").mapInArrow(_link, "a bigint, b bigint"), "near-links")


def find_components(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(`id`, `n`, `root`) for each row: the size of its set and the smallest id it is linked to
    over any number of links.

    Rows with equal sets are linked without comparing them: one id stands for the set.
    Every key's smallest id is compared with the others under that key, which settles most
    copies at one comparison each. Then, where ids under one key are still in different
    components, their signatures are compared in blocks, and all pairs that are near are
    compared in full. So no link between components is missed, no pair is written out,
    and a set travels once for each block that needs it.

    A null or empty text has an empty set and is linked with nothing. Rows that repeat
    an id are one document with several texts, linked when one of them is. A row with a
    null id is linked with nothing, and its root is null. Ids are whole numbers.
    """
    given = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    sketched = written(
        given.select("id", word_hashes(lower_ascii(F.col("text"))).alias("hashes")).mapInArrow(
            _sketch, "id bigint, n bigint, s1 bigint, s2 bigint, sign array<bigint>"
        ),
        "near-sketches",
    )
    known = sketched.where(F.col("id").isNotNull() & (F.col("n") > 0))
    of_set = written(
        known.groupBy("s1", "s2", "n").agg(F.min("id").alias("rep"), F.first("sign").alias("sign")).select(
            "s1", "s2", "n", "rep", *[F.get("sign", F.lit(c)).alias(name) for c, name in enumerate(SIGN)]
        ),
        "near-reps",
    )
    signs = of_set.select(F.col("rep").alias("id"), "n", *SIGN)
    members = known.select("id", "s1", "s2", "n").join(of_set.drop(*SIGN), ["s1", "s2", "n"]).select("id", "rep")
    members = written(members.distinct(), "near-members")
    # An id that stands in several sets ties them.
    ties = members.groupBy("id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    tied = members.join(ties, "id").where("rep <> low").select(F.col("low").alias("a"), F.col("rep").alias("b"))

    keyed = signs.select("id", F.posexplode(lookup_keys()).alias("pos", "key"))
    shared = keyed.groupBy("pos", "key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    buckets = written(keyed.join(shared.drop("last"), ["pos", "key"]).distinct(), "near-buckets")
    texts = given.where(F.col("id").isNotNull())
    stars = buckets.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    stars = written(_near_enough(stars, signs), "near-stars")
    links = _linked(_star_groups(stars), texts).unionByName(tied)

    rooted = components(links, [])
    placed = buckets.select("pos", "key", "id").join(rooted.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "root", F.coalesce("root", "id")
    )
    mixed = placed.groupBy("pos", "key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.ceil(F.count("*") / BLOCK).alias("parts")
    ).where("low < high").select("pos", "key", "parts")
    parted = placed.join(mixed, ["pos", "key"]).join(signs, "id").withColumn("part", F.pmod(F.xxhash64("id"), "parts"))
    # Each part meets each other part of its key, and itself.
    facing = parted.withColumn("_q", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    facing = facing.withColumns({"i": F.least("part", "_q"), "j": F.greatest("part", "_q")})
    met = facing.select("pos", "key", "i", "j", "part", "id", "root", "n", *SIGN)
    met = met.repartition("pos", "key", "i", "j").sortWithinPartitions("pos", "key", "i", "j")
    near = written(met.mapInArrow(_near, "g bigint, id bigint, others array<bigint>"), "near-groups")
    if not near.isEmpty():
        rooted = components(links.unionByName(_linked(near, texts)), [])
    of_rep = members.groupBy("id").agg(F.min("rep").alias("rep")).join(
        rooted.select(F.col("node").alias("rep"), "root"), "rep", "left"
    ).select("id", F.coalesce("root", "rep").alias("root"))
    return sketched.select("id", "n").join(of_rep, "id", "left").select("id", "n", F.coalesce("root", "id").alias("root"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """`id`, `n_shingles`, `component_id` and `kept`, one row a document; see `find_components`.

    The document with the smallest id of its component is kept; a row with a null id is kept.
    """
    found = find_components(docs, text, key)
    return found.select(
        "id", F.col("n").alias("n_shingles"), F.col("root").alias("component_id"), F.col("id").eqNullSafe(F.col("root")).alias("kept")
    )
