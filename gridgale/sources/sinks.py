"""Batch writers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridgale.functions.keys import message_key, message_value
from gridgale.functions.times import calendar_parts, from_epoch_ns
from gridgale.grid import GridSpec
from gridgale.schema import MESSAGE
from gridgale.session import cut_lineage
from gridgale.sources import versions

DAY_COLUMNS = ["year", "month", "day"]
BUCKET_ROWS = 500_000  # rows of a bucket, of about 150 bytes each while they are sorted


def with_day_columns(df: DataFrame, time_column: str = "time") -> DataFrame:
    parts = calendar_parts(F.col(time_column))
    return df.withColumns({name: parts[name] for name in DAY_COLUMNS})


def write_files(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Overwrite a Parquet folder, in `partitions` files if given."""
    if partitions is not None:
        df = df.repartition(partitions)
    df.write.mode("overwrite").parquet(path)


def write_by_day(
    df: DataFrame, path: str, time_column: str = "time", mode: str = "overwrite", files_per_day: int | None = None,
    tasks: int | None = None,
) -> None:
    """Write year/month/day folders.

    Overwriting only replaces the days present in `df`, so loading a day again does
    not repeat its rows. Rows are brought together by day before they are written, so
    that folders hold few files; Spark sizes the pieces at run time and cuts a heavy
    day into several. `files_per_day` fixes their number instead, and `tasks` that of the writing tasks.
    """
    df = with_day_columns(df, time_column)
    if files_per_day is None:
        df = versions.together(df, DAY_COLUMNS, tasks)
    else:
        row = F.xxhash64(*[c for c in df.columns if c not in DAY_COLUMNS])
        df = df.repartition(*DAY_COLUMNS, F.pmod(row, F.lit(files_per_day)))
    writer = df.write.mode(mode).partitionBy(*DAY_COLUMNS)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def buckets_for(df: DataFrame, least: int = 8, rows: int = BUCKET_ROWS) -> int:
    """A number of buckets that grows with the table, so that what one task sorts and merges does not."""
    return max(least, -(-df.count() // rows))


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, **options: str) -> None:
    """Overwrite a catalog table with one file for each bucket of `keys`, sorted by them: tables with equal buckets of
    matching keys are joined as they lie, without a shuffle."""
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").options(**options).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def write_clustered(
    df: DataFrame, path: str, spec: GridSpec, time_column: str = "time", tile: int = 16, group_bytes: int = 8 << 20
) -> None:
    """Overwrite a folder with rows in order of day, tile of the grid, time and place, so that the statistics of row groups
    (of about `group_bytes`) keep a query of few places out of most groups, in space as well as in time."""
    day = F.to_date(time_column).alias("_day")
    tiles = [F.floor(i / F.lit(tile)).alias(n) for n, i in (("_ty", spec.iy(F.col("latitude"))), ("_tx", spec.ix(F.col("longitude"))))]
    order = ["_day", "_ty", "_tx", time_column, "latitude", "longitude"]
    placed = df.select("*", day, *tiles).repartitionByRange(*order[:4]).sortWithinPartitions(*order)
    placed.drop("_day", "_ty", "_tx").write.mode("overwrite").option("parquet.block.size", group_bytes).parquet(path)


def _landed(df: DataFrame, path: str) -> DataFrame | None:
    """What lies in the folder already; nothing before the first batch."""
    try:
        return df.sparkSession.read.parquet(path)
    except AnalysisException as nothing:
        if nothing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def with_instants(df: DataFrame, time_column: str) -> DataFrame:
    """Times as instants; whole numbers are epoch nanoseconds."""
    kind = dict(df.dtypes)[time_column]
    if kind in ("bigint", "int"):
        return df.withColumn(time_column, from_epoch_ns(F.col(time_column).cast("long")))
    return df if kind.startswith("timestamp") else df.withColumn(time_column, F.col(time_column).cast("timestamp_ntz"))


def upsert(old: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of a batch, and the old ones with other keys. A null is a key like any other.

    Keys are as many as the rows of the batch, however small its files are, so they are sorted and never sent to all tasks.
    """
    known = batch.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct().hint("merge")
    same = F.lit(True)
    for k in keys:
        same &= old[k].eqNullSafe(known[f"_{k}"])
    return old.join(known, same, "left_anti").unionByName(batch, allowMissingColumns=True)


def land(
    df: DataFrame | None, path: str, time_column: str = "time", append: bool = False,
    keys: tuple[str, ...] = ("latitude", "longitude"),
) -> None:
    """Take in a freshly fetched batch: times become instants, rows go to day folders.

    Times may be instants, texts, or whole numbers, which are epoch nanoseconds. A batch may
    hold part of a day: it replaces the rows with its own times and `keys`, nulls among them, and the other
    rows of its days stay. Only folders of these days are read and written again, from a
    copy in the shared folder. `append` adds the rows without looking. `land_versions` does the
    same without a moment in which days are missing.
    """
    if df is None:
        raise ValueError("there is no batch to land")
    df = with_instants(df, time_column)
    old = None if append else _landed(df, path)
    if old is not None:
        batch = cut_lineage(df)
        days = with_day_columns(batch, time_column).select(*DAY_COLUMNS).distinct()
        touched = old.join(days, DAY_COLUMNS, "left_semi").drop(*DAY_COLUMNS)
        df = cut_lineage(upsert(touched, batch, [time_column, *[k for k in keys if k in df.columns]]))
    counts = with_day_columns(df.select(time_column), time_column).groupBy(*DAY_COLUMNS).agg(F.count(F.lit(1)).alias("rows"))
    write_by_day(df, path, time_column, mode="append" if append else "overwrite", tasks=versions.writers(counts, "rows"))


def land_versions(
    df: DataFrame | None, path: str, time_column: str = "time", keys: tuple[str, ...] = ("latitude", "longitude")
) -> None:
    """`land` into a folder that keeps versions of its days: they change together when the batch is in, and a batch
    that breaks off changes nothing. `readers.read_landed` reads it."""
    if df is None:
        raise ValueError("there is no batch to land")
    batch = cut_lineage(with_day_columns(with_instants(df, time_column), time_column))
    days = batch.select(*DAY_COLUMNS).distinct()
    known = versions.current(df.sparkSession, path, DAY_COLUMNS)
    old = None if known is None else versions.rows_of(df.sparkSession, path, known.join(days, DAY_COLUMNS, "left_semi"), DAY_COLUMNS)
    rows = batch if old is None else upsert(old, batch, [time_column, *[k for k in keys if k in df.columns]])
    # No day has more rows than all batches brought it.
    landed = cut_lineage(batch.groupBy(*DAY_COLUMNS).agg(F.count(F.lit(1)).alias("rows_landed")))
    before = None if known is None else versions.records(df.sparkSession, path).join(days, DAY_COLUMNS, "left_semi")
    brought = landed if before is None else landed.unionByName(before.select(*landed.columns))
    most = cut_lineage(brought.groupBy(*DAY_COLUMNS).agg(F.sum("rows_landed").alias("rows")))
    version = versions.add_rows(rows, path, DAY_COLUMNS, tasks=versions.writers(most, "rows"), counts=most)
    versions.record(landed, path, version)


def append_table(df: DataFrame, table: str, fmt: str = "parquet", **options: str) -> None:
    df.write.format(fmt).options(**options).mode("append").saveAsTable(table)


def replace_table(df: DataFrame, table: str, fmt: str = "parquet", **options: str) -> None:
    df.write.format(fmt).options(**options).mode("overwrite").saveAsTable(table)


def to_messages(df: DataFrame) -> DataFrame:
    """(key, value) texts of observations that have the message fields."""
    texts = {
        name: F.date_format(F.col(name), "yyyy-MM-dd HH:mm:ss") for name in ("time", "valid_time")
    }
    fields = [texts.get(name, F.col(name)) for name in MESSAGE.names]
    return df.select(
        message_key(texts["time"], F.col("latitude"), F.col("longitude")).alias("key"),
        message_value(fields).alias("value"),
    )


def publish(messages: DataFrame, fmt: str = "kafka", **options: str) -> None:
    """Send messages to a broker topic, or to files when `fmt` says so."""
    writer = messages.write.format(fmt).options(**options).mode("append")
    writer.save()
