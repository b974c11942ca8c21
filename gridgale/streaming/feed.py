"""The live feed: messages in, typed observations out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, FloatType

from gridgale.functions.physics import nan_to_null
from gridgale.schema import MESSAGE, MESSAGE_SEPARATOR


def read_messages(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """A stream with a `value` column. From a broker it starts at the newest messages and
    goes on when the broker has dropped old ones; give `kafka.bootstrap.servers` and
    `subscribe`. Any other stream source of text can stand in for the broker.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", "latest").option("failOnDataLoss", "false")
    reader = reader.options(**options)
    return reader.load(path) if path else reader.load()


def _field(parts: Column, position: int, dtype: DataType) -> Column:
    """Null where the message is too short or the text is no such value."""
    value = F.get(parts, F.lit(position)).try_cast(dtype)
    return nan_to_null(value) if isinstance(dtype, FloatType) else value


def parse_messages(messages: DataFrame) -> DataFrame:
    """Fields by position, and the wind speed. A bad message gives nulls, it never stops the stream."""
    parts = F.split(F.col("value").cast("string"), MESSAGE_SEPARATOR)
    split = messages.select(parts.alias("_p"))
    fields = [_field(F.col("_p"), i, f.dataType).alias(f.name) for i, f in enumerate(MESSAGE.fields)]
    typed = split.select(*fields)
    u, v = F.col("u10").cast("double"), F.col("v10").cast("double")
    return typed.withColumn("wind_speed", F.sqrt(u * u + v * v))


def parse_stream(messages: DataFrame) -> DataFrame:
    if not messages.isStreaming:
        raise ValueError("parse_stream needs a stream; use parse_messages for a batch")
    return parse_messages(messages)
