"""Folders kept as versions of their parts, such as days or months.

New rows of a part are written beside the old ones, under a version of their own, and count from the moment a
record of the version is added, which is one small file and the last step. A job that ends before leaves
what was there; folders of parts that it does not touch are neither read nor written. Readers join rows
with the records, whose parts and versions prune folders while the query runs.

`rows` holds the data in folders part by part and version by version, `records` one row for each part of each
version: the part, the version, its number in time, and what else the job has to say of it. Each file has its cost,
so parts that are known to have few rows lie in `light`, where those of a version that differ in their last column only
(the days of a month) share a folder, with that column in the files. One job writes at a time.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridgale.session import cut_lineage

VERSION, NUMBER = "_version", "_number"
FOLDERS = 64  # folders of few rows that one task writes
HEAVY = 1_000_000  # rows of a folder that are cut at run time
LIGHT = 32_768  # rows of a part that shares a folder; a month of such days has a million


def writers(counts: DataFrame, rows: str) -> int | None:
    """How many tasks write folders whose rows are counted in `counts`; none to be fixed where one is heavy."""
    n, most = counts.agg(F.count(F.lit(1)), F.max(rows)).first()
    return None if n and most > HEAVY else max(1, -(-n // FOLDERS))


def together(df: DataFrame, parts: list[str], tasks: int | None = None) -> DataFrame:
    """Rows of a folder brought together. Folders with few rows cost by their number, so they are dealt to a number of `tasks`;
    else Spark sizes the pieces at run time and cuts heavy folders."""
    return df.hint("rebalance", *parts) if tasks is None else df.repartition(tasks, *parts)


def add_rows(
    df: DataFrame, path: str, parts: list[str], mode: str = "append", tasks: int | None = None, counts: DataFrame | None = None
) -> str:
    """Write new rows of some parts, which nobody reads yet. Returns their version.

    `counts` has the most `rows` that each part can have, and lets parts of few rows share folders; without it each has its own.
    """
    version = uuid.uuid4().hex

    def write(rows: DataFrame, kind: str, folders: list[str]) -> None:
        marked = together(rows.withColumn(VERSION, F.lit(version)), folders, tasks)
        marked.write.mode(mode).partitionBy(*folders, VERSION).parquet(f"{path}/{kind}")

    if counts is None:
        write(df, "rows", parts)
        return version
    own = F.col("rows") > LIGHT
    n, n_own = counts.agg(F.count(F.lit(1)), F.count_if(own)).first()
    if 0 < n_own < n:
        df, heavy = cut_lineage(df), counts.where(own).select(*parts)
        write(df.join(heavy, parts, "left_semi"), "rows", parts)
        write(df.join(heavy, parts, "left_anti"), "light", parts[:-1])
    elif n_own:
        write(df, "rows", parts)
    else:
        write(df, "light", parts[:-1])
    return version


def record(parts_with_facts: DataFrame, path: str, version: str) -> None:
    """From now on the version's rows are those of the listed parts; a part without rows is empty."""
    known = records(parts_with_facts.sparkSession, path)
    last = F.lit(0) if known is None else F.coalesce(known.agg(F.max(NUMBER)).scalar(), F.lit(0))
    numbered = parts_with_facts.withColumns({VERSION: F.lit(version), NUMBER: (last + 1).cast("long")})
    numbered.coalesce(1).write.mode("append").parquet(f"{path}/records")


def _written(spark: SparkSession, path: str) -> DataFrame | None:
    """What lies in a folder; none before the first rows."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as nothing:
        if nothing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def records(spark: SparkSession, path: str) -> DataFrame | None:
    """All records so far; none before the first."""
    return _written(spark, f"{path}/records")


def current(spark: SparkSession, path: str, parts: list[str]) -> DataFrame | None:
    """The record in force of each part."""
    known = records(spark, path)
    if known is None:
        return None
    newest = Window.partitionBy(*parts).orderBy(F.col(NUMBER).desc(), VERSION)
    return known.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def rows_of(spark: SparkSession, path: str, chosen: DataFrame, parts: list[str]) -> DataFrame | None:
    """The rows of some records of `current`, with the parts as columns; none where no version has rows."""
    kinds, out = dict(chosen.dtypes), None
    for kind in ("rows", "light"):
        rows = _written(spark, f"{path}/{kind}")
        if rows is None:
            continue
        typed = rows.withColumns({p: F.col(p).cast(kinds[p]) for p in parts if dict(rows.dtypes)[p] != kinds[p]})
        picked = typed.join(chosen.select(*parts, VERSION), [*parts, VERSION]).drop(VERSION)
        out = picked if out is None else out.unionByName(picked, allowMissingColumns=True)
    return out
