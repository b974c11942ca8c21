"""Stream sinks. Checkpoints always lie outside the folder they protect."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

log = logging.getLogger(__name__)

TRIGGER = "10 seconds"


def _writer(stream: DataFrame, checkpoint: str, once: bool, trigger: str) -> DataStreamWriter:
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)


def _outside(checkpoint: str, path: str) -> None:
    if checkpoint.rstrip("/").startswith(path.rstrip("/") + "/"):
        raise ValueError("keep the checkpoint outside the data folder")


def to_files(
    stream: DataFrame, path: str, checkpoint: str, once: bool = False, trigger: str = TRIGGER, fmt: str = "parquet"
) -> StreamingQuery:
    """Append to files; the sink's own log makes each batch appear exactly once."""
    _outside(checkpoint, path)
    return _writer(stream, checkpoint, once, trigger).format(fmt).option("path", path).start()


def to_table(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    once: bool = False,
    trigger: str = TRIGGER,
    fmt: str = "parquet",
    **options: str,
) -> StreamingQuery:
    """Append to a catalog table; its connector is `fmt` with its `options`."""
    return _writer(stream, checkpoint, once, trigger).options(**options).toTable(table, format=fmt)


def log_batch(batch_id: int, rows: int) -> None:
    log.info("batch %d: %s", batch_id, f"{rows} rows" if rows else "no new data")


class Ledger:
    """What became of each batch, as small files in a folder that readers of the data pass over: a batch is noted as
    `begun` before the table is loaded and as `done` after it. Only the ledger is read after a start, and
    the table only for a batch that was begun and not done."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path.rstrip('/')}/_ledger"

    def note(self, run: str, batch: int, rows: int, state: str) -> None:
        row = self.spark.range(1).select(
            F.lit(run).alias("run"), F.lit(batch).cast("long").alias("batch"), F.lit(rows).cast("long").alias("rows"), F.lit(state).alias("state")
        )
        row.coalesce(1).write.mode("append").parquet(self.path)

    def states(self, run: str, batch: int) -> set[str]:
        try:
            noted = self.spark.read.parquet(self.path).where((F.col("run") == run) & (F.col("batch") == batch))
            return {s for s in ("begun", "done") if not noted.where(F.col("state") == s).isEmpty()}
        except AnalysisException as nothing:
            if nothing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return set()
            raise


def to_files_and_table(
    stream: DataFrame,
    path: str,
    table: str | None,
    checkpoint: str,
    on_batch: Callable[[int, int], None] = log_batch,
    once: bool = False,
    trigger: str = TRIGGER,
    table_options: dict[str, str] | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """One query that reads the topic once and writes both places, then reports the batch.

    A batch is known by its run, the id that Spark keeps in the checkpoint, and its number:
    a new checkpoint numbers from 0 again, but under a run of its own. Files go to a folder
    of that run and batch, replaced as a whole when a batch is run again after a failure.
    The table, in the connector `fmt`, is loaded from that folder with `run` and `batch` as
    columns, in partitions by `day` of `time`. Only the first batch after a start can have
    been loaded before: the ledger beside the files tells, and where a batch was cut off while it was
    being loaded, the days it has in the table. The topic is not read again.
    """
    _outside(checkpoint, path)
    started: list[int] = []

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        ledger = Ledger(spark, path)
        target = f"{path.rstrip('/')}/run={run}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(target)
        written = spark.read.schema(batch.schema).parquet(target)
        rows = written.count()  # from the file footers
        if table is not None and rows:
            marked = written.withColumns(
                {"run": F.lit(run), "batch": F.lit(batch_id).cast("long"), "day": F.to_date("time")}
            )
            before = set() if started else ledger.states(run, batch_id)
            loaded = "done" in before
            if before == {"begun"} and spark.catalog.tableExists(table):
                there = spark.table(table).where((F.col("run") == run) & (F.col("batch") == batch_id))
                days = marked.select(F.col("day").alias("_day")).distinct()
                loaded = not there.join(days, F.col("day").eqNullSafe(F.col("_day")), "left_semi").isEmpty()
            if not loaded:
                ledger.note(run, batch_id, rows, "begun")
                marked.write.format(fmt).mode("append").options(**(table_options or {})).partitionBy("day").saveAsTable(table)
            if "done" not in before:
                ledger.note(run, batch_id, rows, "done")
        started.append(batch_id)
        on_batch(batch_id, rows)

    return _writer(stream, checkpoint, once, trigger).foreachBatch(store).start()


def run_until_one_ends(spark: SparkSession, *queries: StreamingQuery) -> None:
    """Wait until any of the running queries ends, and raise its error if it failed."""
    spark.streams.resetTerminated()
    if all(q.isActive for q in queries):
        spark.streams.awaitAnyTermination()
    for q in queries:
        if not q.isActive and q.exception() is not None:
            raise q.exception()
