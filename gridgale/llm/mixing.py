"""Mixing sources to target weights by Sainte-Laguë apportionment, with column functions only.

Documents are dealt into shards. In a shard each source's words, in a seeded order, are
cut into blocks of equal length, the last one shorter. The shard's quota of blocks goes to the sources by
highest quotients, which gives each source a whole number of blocks, and that many are
picked evenly from a seeded start. A document gives the words that fall into picked blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridgale.llm.common import SPACE, WORD, unpacked, words, written

WEIGHTS = (5.0, 2.0, 1.0)
VOLUME = 1.5  # of all words
MOST = 2  # times a source's words
BLOCK = 32  # words
SHARD = 1 << 18  # words
SEED = 11


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, volume: float = VOLUME, most: float = MOST
) -> DataFrame:
    """`source`, `source_size`, `target` from (`source`, `source_size`), one row a source.

    Sources in the order of code points, null last, weigh `weights` in turn and share
    `volume` times all words. A target stops at `most` times its source; what is left goes
    to the others by weight. So all sources below their stop have one target per weight,
    the level. With sources sorted by stop per weight, it is the first level that the
    source at hand can still take while all before it stop. Windows run over one row a source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.select(
        "source", "source_size", place.alias("_i"), (F.lit(float(most)) * F.col("source_size")).alias("_stop")
    ).withColumn("_w", F.get(weight, F.pmod(F.col("_i"), F.lit(len(weights)))))
    reach = F.col("_stop") / F.col("_w")
    by_reach = Window.orderBy(reach, "_i")
    whole = by_reach.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stopped = F.coalesce(F.sum("_stop").over(by_reach.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("_w").over(by_reach.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    left = F.lit(float(volume)) * F.sum("source_size").over(whole) - stopped
    levels = weighed.withColumn("_level", left / open_weight)
    level = F.first(F.when(F.col("_level") <= reach, F.col("_level")), True).over(whole)
    target = F.when(level.isNull(), F.col("_stop")).otherwise(F.least(F.col("_stop"), F.col("_w") * level))
    return levels.select("source", "source_size", target.alias("target"))


def quotas(cells: DataFrame) -> DataFrame:
    """Add `quota` to (`shard`, `source`, `words`, `blocks`, `wanted`): the blocks a source gets.

    A shard's seats are its wanted blocks, rounded. Seat a + 1 of a source has the quotient
    wanted / (2a + 1), and the highest quotients win; ties go to the source first in order.
    Only seats between the bounds that the final divisor can have, about three a source,
    are laid out and ranked. A source gets at most `MOST` times its blocks.
    """
    shard = Window.partitionBy("shard")
    n, total = F.count("*").over(shard), F.sum("wanted").over(shard)
    sized = cells.withColumns({"_n": n, "_total": total})
    sized = sized.withColumn("_seats", F.floor(F.col("_total") + 0.5))
    stop = (F.lit(MOST) * F.col("blocks")).cast("long")

    def rounded(change: Column) -> Column:
        share = F.col("wanted") * F.greatest(F.col("_seats") + change, F.lit(0.0)) / F.col("_total")
        return F.when(F.col("_total") > 0, F.floor(share + 0.5)).otherwise(F.lit(0).cast("long"))

    bounded = sized.withColumns({
        "_low": F.least(F.greatest(rounded(-F.col("_n") / 2) - 1, F.lit(0)), stop).cast("long"),
        "_high": F.least(rounded(F.col("_n") / 2) + 1, stop).cast("long"),
    })
    bounded = bounded.withColumn("_open", F.col("_seats") - F.sum("_low").over(shard))
    tried = bounded.withColumn(
        "_a", F.explode_outer(F.when(F.col("_high") > F.col("_low"), F.sequence(F.col("_low"), F.col("_high") - 1)))
    )
    quotient = F.col("wanted") / (2 * F.col("_a") + 1)
    place = F.row_number().over(shard.orderBy(quotient.desc_nulls_last(), F.col("source").asc_nulls_last(), "_a"))
    won = tried.withColumn("_won", (F.col("_a").isNotNull() & (place <= F.col("_open"))).cast("long"))
    return won.groupBy("shard", "source", "words", "blocks", "wanted").agg(
        (F.first("_low") + F.sum("_won")).alias("quota")
    )


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def mix_sources(
    docs: DataFrame, carry: list[str] | None = None, text: str = "text", source: str = "source",
    key: str = "doc_id", seed: int = SEED, block_words: int = BLOCK, shard_words: int = SHARD,
) -> DataFrame:
    """`row` (the columns `carry`, by default all) with `size`, `source_size`, `target`,
    `taken`, and the place in the cell that `mixed_texts` needs.

    A null text has no words and takes none; null is a source of its own; a source
    without words has target 0. Rows that repeat a key or a text are rows of their own;
    equal rows stand next to each other, so it does not matter which comes first. A very
    long text spans many blocks. An empty table stays empty. Reruns give the same mix,
    since all draws are hashes of `seed` and the row.
    """
    own = f"`{text}`", f"`{source}`", f"`{key}`"
    t, s, k = (F.col(c) for c in own)
    told = F.concat_ws("|", F.lit(str(seed)), k.cast("string"), s.cast("string"), F.md5(F.coalesce(t, F.lit("")).cast("binary")))
    sized = written(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in (carry or docs.columns)]).alias("row"),
            F.size(words(t)).cast("long").alias("size"),
            s.cast("string").alias("source"),
            F.md5(told.cast("binary")).alias("draw"),
        ),
        "mix-sized",
    )
    sources = written(
        source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "mix-sources"
    )
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_words))
    dealt = sized.withColumn("shard", F.pmod(F.conv(F.substring("draw", 1, 12), 16, 10).cast("long"), F.lit(shards)))
    cells = dealt.groupBy("shard", "source").agg(F.sum("size").alias("words"))
    same_source = F.col("source").eqNullSafe(F.col("_source"))
    known = sources.withColumnRenamed("source", "_source")
    wanted = cells.join(known, same_source).drop("_source").select(
        "shard", "source", "words", F.ceil(F.col("words") / block_words).alias("blocks"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") * F.ceil(F.col("words") / block_words))
        .otherwise(F.lit(0.0)).alias("wanted"),
    )
    start = F.pmod(
        F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), "shard", "source").cast("binary")), 1, 12), 16, 10).cast("long"),
        F.greatest("blocks", F.lit(1)),
    )
    allotted = quotas(wanted).select(
        F.col("shard").alias("_shard"), F.col("source").alias("_source"), "quota",
        F.greatest("blocks", F.lit(1)).alias("blocks"), start.alias("start"),
    )
    cell = Window.partitionBy("shard", "source").orderBy("draw", "size")
    placed = dealt.withColumn("first", F.sum("size").over(cell.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    joined = placed.join(
        allotted, (F.col("shard") == F.col("_shard")) & F.col("source").eqNullSafe(F.col("_source"))
    ).drop("_shard", "_source").join(known, same_source).drop("_source")

    def taken_before(word: Column) -> Column:
        block = _div(word, F.lit(block_words))
        here = _picked(block + 1) - _picked(block)
        return block_words * _picked(block) + here * (word - block_words * block)

    taken = taken_before(F.col("first") + F.col("size")) - taken_before(F.col("first"))
    return joined.select(
        "row", "size", "source_size", "target", taken.cast("long").alias("taken"),
        "first", "quota", "blocks", "start", F.lit(block_words).alias("block_words"),
    )


def _picked(blocks: Column) -> Column:
    """How many of the cell's first `blocks` blocks are taken, repeats counted: even steps
    from the seeded start, `quota` in all."""
    return _div(blocks * F.col("quota") + F.col("start"), F.col("blocks"))


def mixed_texts(mix: DataFrame, text: str = "text") -> DataFrame:
    """The documents' columns again, one row for each pass over a document that takes
    words; `text` holds the words of the blocks taken in that pass, with the white space after each."""
    block = F.col("block_words")
    pieces = F.regexp_extract_all(F.col("row")[text], F.lit(f"{WORD}{SPACE}*"), F.lit(0))
    blocks = F.sequence(_div(F.col("first"), block), _div(F.col("first") + F.col("size") - 1, block))
    passes = mix.where("taken > 0").withColumns({"_pieces": pieces, "_blocks": blocks})
    passes = passes.withColumn("_pass", F.explode(F.sequence(F.lit(1), F.lit(MOST))))

    def part(j: Column) -> Column:
        begin = F.greatest(j * block - F.col("first"), F.lit(0))
        end = F.least((j + 1) * block - F.col("first"), F.col("size"))
        copies = _picked(j + 1) - _picked(j)
        return F.when(
            copies >= F.col("_pass"),
            F.array_join(F.slice("_pieces", (begin + 1).cast("int"), (end - begin).cast("int")), ""),
        ).otherwise("")

    joined = passes.withColumn("_text", F.array_join(F.transform("_blocks", part), ""))
    return unpacked(joined.where("_text <> ''"), **{text: F.col("_text")})
