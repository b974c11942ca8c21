"""Phrases whose words stand together more often than apart, by prefix-free parsing.

A piece of text is parsed into chunks: a chunk ends with four words whose hash triggers, and the next
chunk begins with the same four. The cuts depend on the words around them alone, so text that
repeats falls into the same chunks, and the corpus becomes a dictionary of distinct chunks
and how often the parse uses each. Phrases of up to five words are counted inside the
distinct chunks, times their use. A phrase belongs to the chunk in which it begins before the last four
words (in a piece's last chunk, anywhere), so what lies in an overlap counts once.

A phrase cannot be frequent unless each of its words is. So words are counted first, and the frequent
ones get numbers. Each place of a chunk gives one row, its window: the numbers of up to five words from there
on, as far as they are frequent. Windows that begin with the same pair of words meet in one task, where, once they are
sorted, the windows of a phrase are neighbours. So there are no more rows than places, and a task sends on
only phrases that are frequent. Pairs that begin a very large share of a sample's windows are dealt by their third word too.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridgale.llm.common import ranked, written

LEAST = 100  # occurrences of a candidate
LONGEST = 5  # words of a phrase
TOP = 2000  # phrases of a language
OVERLAP = LONGEST - 1
TRIGGER = 16  # a chunk has about so many words besides its overlap; shorter pieces are not cut
MOST_WORDS = 256  # a chunk without a trigger is cut here
FEW_PAIRS = 1_000_000  # pairs of a language and a frequent word that are sent to all tasks; more are joined
BATCH_BYTES = 8 << 20
SAMPLED = 50_000  # chunks, about, that tell how many windows there are and which pairs begin very many
PART_WINDOWS = 400_000  # windows of a task, about
HEAVY_WINDOWS = 200_000  # a pair that begins more is dealt over tasks
BLOCK_BYTES = 32 << 20  # windows that a task sorts at once
DISTINCT, HELD_BYTES = 400_000, 32 << 20  # pieces, and bytes of texts, that a task counts before it sends them on
KEYS = ["front", "middle", "end"]  # the columns of a window
# What parts pieces of a text.
BREAK = re.compile(rb"[.,;:!?\n-\r]")


def chunks(words: list[bytes]) -> Iterator[tuple[bytes, bool]]:
    """The chunks of a piece, and whether each is its last."""
    begin, last = 0, len(words) - OVERLAP
    if len(words) > TRIGGER:
        for i in range(1, last):
            if i - begin >= MOST_WORDS or zlib.crc32(b" ".join(words[i:i + OVERLAP])) % TRIGGER == 0:
                yield b" ".join(words[begin:i + OVERLAP]), False
                begin = i
    yield b" ".join(words[begin:]), True


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(`lang`, `chunk`, `last`, `uses`) of the texts of a task."""
    pieces: dict[str, Counter] = {}

    def parsed() -> Iterator[pa.RecordBatch]:
        for lang, counted in pieces.items():
            out: Counter = Counter()
            for piece, uses in counted.items():
                if words := piece.split():
                    for chunk in chunks(words):
                        out[chunk] += uses
            columns = [
                pa.array([lang] * len(out), pa.string()), _strings([c for c, _ in out]),
                pa.array([last for _, last in out], pa.bool_()), pa.array(list(out.values()), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "chunk", "last", "uses"])
        pieces.clear()

    held = 0
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
            if text.is_valid:
                # Of bytes, lower() takes A to Z alone.
                small = text.as_buffer().to_pybytes().lower()
                pieces.setdefault(lang, Counter()).update(BREAK.split(small))
                held += len(small)
                if held > HELD_BYTES or sum(map(len, pieces.values())) > DISTINCT:
                    yield from parsed()
                    held = 0
    yield from parsed()


def _larger(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[pa.Table]:
    """Batches put together, since what a task counts at once is sent on once."""
    held, size, most = [], 0, most or BATCH_BYTES
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


class Words:
    """The words of a batch of chunks, one after another, as numbers."""

    def __init__(self, table: pa.Table):
        parts = pc.split_pattern(table["chunk"].combine_chunks(), " ")
        coded = parts.flatten().dictionary_encode()
        self.known, self.ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        langs = table["lang"].combine_chunks().dictionary_encode()
        self.langs, lang = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        size = pc.list_value_length(parts).to_numpy()
        uses, last = table["uses"].to_numpy(), table["last"].to_numpy(zero_copy_only=False)
        self.chunk = np.repeat(np.arange(len(size)), size)
        self.place = np.arange(len(self.ids)) - np.repeat(np.cumsum(size) - size, size)
        self.lang, self.uses = lang[self.chunk].astype(np.int64), uses[self.chunk]
        self.left = size[self.chunk] - self.place  # words from here to the chunk's end
        self.begins = last[self.chunk] | (self.left > OVERLAP)  # whether phrases that begin here are the chunk's own

    def summed(self, key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the places `at`: a place of each different key, the key's number by place, and its uses."""
        _, first, number = np.unique(key[at], return_index=True, return_inverse=True)
        uses = np.zeros(len(first), np.int64)
        np.add.at(uses, number, self.uses[at])
        return at[first], number, uses


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _larger(batches):
        words = Words(table)
        at, _, uses = words.summed(words.lang * len(words.known) + words.ids, np.flatnonzero(words.begins))
        columns = [pa.array([words.langs[i] for i in words.lang[at]], pa.string()), words.known.take(pa.array(words.ids[at])), pa.array(uses)]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "uses"])


class Windows:
    """Windows as three numbers each, which hold two or three words of `bits` bits; 0 where a window is shorter."""

    def __init__(self, numbers: int):
        self.bits = max(1, numbers.bit_length())
        self.each = 3 if self.bits <= 21 else 2

    def at(self, i: int) -> tuple[int, int]:
        """Which number holds word `i`, and the bits below the word."""
        return i // self.each, self.bits * (self.each - 1 - i % self.each)

    def packed(self, words: list[np.ndarray]) -> list[np.ndarray]:
        out = [np.zeros(len(words[0]), np.int64) for _ in KEYS]
        for i, word in enumerate(words):
            key, below = self.at(i)
            out[key] |= word << below
        return out

    def masks(self, n: int) -> list[int]:
        """What the first `n` words take of each number."""
        out = [0 for _ in KEYS]
        for i in range(n):
            key, below = self.at(i)
            out[key] |= ((1 << self.bits) - 1) << below
        return out

    def word(self, i: int) -> Column:
        key, below = self.at(i)
        return F.shiftright(KEYS[key], below).bitwiseAND((1 << self.bits) - 1)

    def pair(self) -> Column:
        """The first two words."""
        return F.shiftright(KEYS[0], self.at(1)[1])


def _place_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(`id` of the chunk, `place`, `lang`, `phrase`) for all words."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        words = Words(table)
        chunk = pa.array(words.chunk)
        columns = [table["id"].combine_chunks().take(chunk), pa.array(words.place.astype(np.int32)), table["lang"].combine_chunks().take(chunk), words.known.take(pa.array(words.ids))]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "place", "lang", "phrase"])


def _windows(form: Windows, frequent: dict[str, tuple[pa.Array, np.ndarray]] | None) -> Callable:
    """The windows of two words and more; the numbers of frequent words are by language in `frequent`, or else
    in the column `places`."""

    def numbered(words: Words, table: pa.Table) -> np.ndarray:
        out = np.zeros(len(words.ids), np.int64)
        if frequent is None:
            begin = np.searchsorted(words.chunk, np.arange(len(table)))
            places = table["places"].combine_chunks()
            of = places.flatten()
            out[np.repeat(begin, pc.list_value_length(places).to_numpy()) + of.field("place").to_numpy()] = of.field("number").to_numpy()
            return out
        number = np.zeros(len(words.known), np.int64)
        for i, lang in enumerate(words.langs):
            if lang in frequent:
                at = np.flatnonzero(words.lang == i)
                ids = pd.unique(words.ids[at])
                spelled, numbers = frequent[lang]
                found = pc.index_in(words.known.take(pa.array(ids)), value_set=spelled).fill_null(-1).to_numpy()
                number[ids] = np.where(found < 0, 0, numbers[found])
                out[at] = number[words.ids[at]]
        return out

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _larger(batches):
            words = Words(table)
            number = np.append(numbered(words, table), np.zeros(LONGEST, np.int64))
            at = np.flatnonzero(words.begins & (words.left > 1) & (number[:-LONGEST] > 0) & (number[1:1 - LONGEST] > 0))
            left, window = words.left[at], []
            going = np.ones(len(at), bool)
            for i in range(LONGEST):
                window.append(np.where(going & (left > i), number[at + i], 0))
                going = window[-1] > 0
            columns = [pa.array(c) for c in [*form.packed(window), words.uses[at]]]
            yield pa.RecordBatch.from_arrays(columns, names=[*KEYS, "uses"])

    return work


def _count_windows(form: Windows, heavy: np.ndarray, least: int) -> Callable:
    """Phrases that begin windows, and their uses: frequent ones, and those of which other tasks or blocks may count more."""

    def counted(table: pa.Table, parted: bool) -> Iterator[pa.RecordBatch]:
        keys = [table[k].to_numpy() for k in KEYS]
        order = np.lexsort(keys[::-1])
        keys, uses = [k[order] for k in keys], table["uses"].to_numpy()[order]
        differ = [k[1:] ^ k[:-1] for k in keys]
        for n in range(2, LONGEST + 1):
            masks = form.masks(n)
            new = np.zeros(len(uses), bool)
            new[0] = True
            for d, m in zip(differ, masks):
                new[1:] |= (d & m) != 0
            first = np.flatnonzero(new)
            total = np.add.reduceat(uses, first)
            key, below = form.at(n - 1)
            sent = (total >= least) | parted
            if n == 2:
                sent |= np.isin(keys[0][first] >> below, heavy)
            sent &= (keys[key][first] >> below) & ((1 << form.bits) - 1) > 0
            first, total = first[sent], total[sent]
            columns = [*[k[first] & m for k, m in zip(keys, masks)], np.full(len(first), n, np.int32), total]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[*KEYS, "words", "uses"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _larger((b for b in batches if len(b)), BLOCK_BYTES)
        block, parted = next(blocks, None), False
        while block is not None:
            after = next(blocks, None)
            parted |= after is not None
            yield from counted(block, parted)
            block = after

    return work


def chunk_dictionary(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(`id`, `lang`, `chunk`, `last`, `uses`): the distinct chunks of all texts, as a table."""
    given = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))
    parsed = given.mapInArrow(_parse, "lang string, chunk string, last boolean, uses bigint")
    used = parsed.groupBy("lang", "chunk", "last").agg(F.sum("uses").alias("uses"))
    return written(used.withColumn("id", F.monotonically_increasing_id()), "chunks")


def numbered_words(words: DataFrame) -> DataFrame:
    """`words` with a `number` each: 1, 2, 3, ... without gaps."""
    dealt = ranked(words.withColumn("_all", F.lit(0)), ["_all"], ["lang", "phrase"], "number")
    return written(dealt.select("lang", "phrase", (F.col("number") + 1).alias("number")), "numbers")


def frequent_phrases(chunked: DataFrame, words: DataFrame, least: int = LEAST) -> DataFrame:
    """(`lang`, `phrase`, `words`, `a`): phrases of two words and more that occur at least `least` times, made of `words`."""
    numbers = numbered_words(words)
    many = numbers.count()
    form = Windows(many)
    schema = ", ".join(f"{c} bigint" for c in [*KEYS, "uses"])
    if many <= FEW_PAIRS:
        known = numbers.toArrow().to_pandas()
        frequent = {lang: (pa.array(of["phrase"], pa.string()), of["number"].to_numpy()) for lang, of in known.groupby("lang")}

        def windows(of: DataFrame) -> DataFrame:
            return of.mapInArrow(_windows(form, frequent), schema)
    else:
        def windows(of: DataFrame) -> DataFrame:
            places = of.mapInArrow(_place_words, "id bigint, place int, lang string, phrase string").join(numbers, ["lang", "phrase"])
            of_chunk = places.groupBy("id").agg(F.collect_list(F.struct("place", "number")).alias("places"))
            return of.join(of_chunk, "id").mapInArrow(_windows(form, None), schema)

    # The sample deals windows to tasks, and has no say in what is counted.
    step = max(1, chunked.count() // SAMPLED)
    sampled = windows(chunked.where(F.pmod(F.xxhash64("id"), F.lit(step)) == 0))
    begun = sampled.groupBy(form.pair().alias("pair")).agg((F.count("*") * step).alias("n"))
    size, heavy = begun.agg(F.sum("n"), F.collect_list(F.when(F.col("n") > HEAVY_WINDOWS, F.col("pair")))).first()
    deal = form.pair()
    if heavy:
        deal = F.when(deal.isin(heavy), F.xxhash64(deal, form.word(2))).otherwise(deal)
    dealt = windows(chunked).repartition(max(1, (size or 0) // PART_WINDOWS), deal)
    sums = dealt.mapInArrow(_count_windows(form, np.array(heavy, np.int64), least), schema.replace("uses", "words int, uses"))
    counted = sums.groupBy(*KEYS, "words").agg(F.sum("uses").alias("a")).where(F.col("a") >= least)
    # A phrase is spelled by its numbers.
    spelled = counted.select("*", F.posexplode(F.slice(F.array(*[form.word(i) for i in range(LONGEST)]), F.lit(1), F.col("words"))).alias("at", "number"))
    spelled = spelled.join(numbers, "number").groupBy(*KEYS, "words", "a").agg(
        F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "phrase"))).alias("spelled")
    )
    return spelled.select("lang", F.array_join("spelled.phrase", " ").alias("phrase"), "words", "a")


def _scored(phrases: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """Each phrase with its lowest-scoring cut: `l`, `r`, `n` and `score`."""
    spelled = F.split("phrase", " ")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "*", F.array_join(F.slice(spelled, F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice(spelled, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right"),
    )
    parts = words.unionByName(phrases.select("lang", "phrase", "a"))
    counted = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"]).join(
        parts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"]
    ).join(totals, "lang")
    # Counts below 10^16 and sums below 10^18 keep all products within 38 digits.
    above = (F.col("a") * 1000).cast("decimal(19,0)") * F.col("n").cast("decimal(18,0)")
    below = F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)")
    scored = counted.select("lang", "phrase", "words", "a", "n", F.struct(F.call_function("div", above, below).alias("score"), "k", "l", "r").alias("cut"))
    return scored.groupBy("lang", "phrase", "words", "a", "n").agg(F.min("cut").alias("cut")).select(
        "lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score"
    )


def _maximal(phrases: DataFrame) -> DataFrame:
    """Phrases that no longer frequent phrase holds and matches in occurrences."""
    spelled = F.split("phrase", " ")
    inner = phrases.where(F.col("words") > 2).withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = inner.withColumn("begin", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    held = inner.select("lang", F.array_join(F.slice(spelled, F.col("begin"), F.col("size")), " ").alias("phrase"), F.col("a").alias("of"))
    most = held.groupBy("lang", "phrase").agg(F.max("of").alias("of"))
    return phrases.join(most, ["lang", "phrase"], "left").where(F.col("of").isNull() | (F.col("of") < F.col("a"))).drop("of")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """(`lang`, `rank`, `phrase`, `a`, `l`, `r`, `n`, `score`): the best `top` phrases of each language.

    Texts are lower-cased (A to Z), split into pieces at marks and line ends and into words at blanks and
    tabs. A phrase of 2 to 5 words that occurs `a >= least` times within pieces scores
    `floor(1000 * a * n / (l * r))` at its worst cut into a first part seen `l` times and a rest seen
    `r` times, of `n` words in all; equal scores take the earliest cut. Phrases inside a longer one that occurs as
    often go. Equal ranks are told apart by `a` and then by the phrase's bytes.

    A null language is `und`, a null or empty text has no pieces; documents that repeat count each. A
    very long text is parsed like any other. An empty table gives no phrase. Columns besides the
    two named are not read.
    """
    chunked = chunk_dictionary(docs, text, lang)
    counted = chunked.mapInArrow(_count_words, "lang string, phrase string, uses bigint")
    words = written(counted.groupBy("lang", "phrase").agg(F.sum("uses").alias("a")), "words")
    often = words.where(F.col("a") >= least)
    phrases = written(frequent_phrases(chunked, often, least), "phrases")
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    best = _scored(phrases, often, totals)
    kept = best.join(_maximal(phrases).select("lang", "phrase"), ["lang", "phrase"])
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # Each of 64 parts gives its best, so that a language's last sort has a bounded number of rows.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = kept.withColumn("_p", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_p").orderBy(*order)))
    ranked = first.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
