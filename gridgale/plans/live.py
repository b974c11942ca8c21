"""The live job: messages in, files and a table out."""

from __future__ import annotations

from pyspark.sql import SparkSession

from gridgale.streaming import feed, sinks


def stream_job(
    spark: SparkSession,
    path: str,
    table: str | None,
    checkpoint: str,
    fmt: str = "kafka",
    source: str | None = None,
    once: bool = False,
    trigger: str = sinks.TRIGGER,
    table_format: str = "parquet",
    table_options: dict[str, str] | None = None,
    **options: str,
) -> None:
    """Read messages (`fmt` with its `options`, or from the folder `source`), parse them, write each
    batch to files and to a table, and wait until the query ends, raising its error if it failed.
    """
    stream = feed.parse_stream(feed.read_messages(spark, fmt, source, **options))
    query = sinks.to_files_and_table(
        stream, path, table, checkpoint, once=once, trigger=trigger, table_options=table_options, fmt=table_format
    )
    sinks.run_until_one_ends(spark, query)
