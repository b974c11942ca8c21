"""What the text operators share: word patterns, written tables, distributed ranks."""

from __future__ import annotations

import string
import time
from functools import wraps

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridgale.session import shared_path

# What parts words, and the same characters for trimming.
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once, also where a lambda uses it again and again."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """The words of a text; of null, none."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def word_hashes(text: Column) -> Column:
    """A 64-bit hash for each word, the form in which words go to Python."""
    return F.transform(words(text), lambda w: F.xxhash64(w))


def written(df: DataFrame, name: str) -> DataFrame:
    """`df`, stored in the shared folder and read from there: computed once, and a lost
    executor costs no more than reading a file again."""
    path = shared_path(df.sparkSession, name)
    if _at_work is not None:
        _at_work.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# The inner tables of the stage at work, and by application those of stages that have returned, with the time.
_at_work: list[str] | None = None
_left: dict[str, list[tuple[str, float]]] = {}


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it is stored."""
    files, place = _place(spark, path)
    files.delete(place, True)


def _written_at(docs: DataFrame) -> float:
    """When the documents' files were written, in seconds; 0 where they come from no files."""
    given = docs.inputFiles()
    if not given:
        return 0.0
    files, place = _place(docs.sparkSession, given[0])
    return files.getFileStatus(place).getModificationTime() / 1000


def as_stage(work):
    """A stage of a pipeline, whose result is written and reread before the next stage begins.

    Its inner tables are needed until its result is written. They go when a stage begins on documents that were
    written after it had returned, and that are not read from these tables themselves. Tables
    that operators write outside of stages stay.
    """

    @wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        global _at_work
        left = _left.pop(spark.sparkContext.applicationId, [])
        if left:
            at, given = _written_at(docs), docs.inputFiles()
            over = [p for p, returned in left if returned < at and not any(p.rsplit("/", 1)[1] in f for f in given)]
            for path in over:
                remove(spark, path)
            left = [x for x in left if x[0] not in over]
        before, _at_work = _at_work, []
        try:
            return work(spark, docs, sf_dir)
        finally:
            _left[spark.sparkContext.applicationId] = left + [(p, time.time()) for p in _at_work]
            _at_work = before

    return stage


def packed(df: DataFrame) -> DataFrame:
    """All columns in one column `row`, so that no name of theirs meets a name of ours."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unpacked(df: DataFrame, **changes: Column) -> DataFrame:
    """The columns of `row` again, some of them replaced."""
    fields = df.schema["row"].dataType.fieldNames()
    return df.select(*[changes.get(f, F.col("row")[f]).alias(f) for f in fields])


def ranked(df: DataFrame, group: list[str], order: list[str], name: str, per_bucket: int = 20_000) -> DataFrame:
    """Add `name`: 0, 1, 2, ... without gaps in each group.

    A group may hold any share of the rows: its rows are dealt over buckets by a hash of
    `order`, ranked inside the bucket, and moved on by the rows of the buckets before it.
    Equal rows take neighbouring ranks. `df` is read twice and should be a table.
    """
    buckets = max(1, -(-df.count() // per_bucket))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(F.lit(17), *order), F.lit(buckets)))
    counts = dealt.groupBy(*group, "_bucket").agg(F.count("*").alias("_n"))
    before = (
        "coalesce(sum(_n) over (partition by {} order by _bucket rows between unbounded preceding"
        " and 1 preceding), 0)"
    ).format(", ".join(group))
    starts = counts.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col("_bucket").alias("_b"),
        F.expr(before).alias("_start"),
    )
    inside = F.expr(
        "row_number() over (partition by {}, _bucket order by {}) - 1".format(", ".join(group), ", ".join(order))
    )
    local = dealt.withColumn("_inside", inside)
    same = F.col("_bucket") == F.col("_b")
    for i, g in enumerate(group):
        same &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return local.join(starts, same).withColumn(name, F.col("_start") + F.col("_inside")).drop(
        "_bucket", "_inside", "_b", "_start", *[f"_g{i}" for i in range(len(group))]
    )


def mix64(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit value for each 64-bit value."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
