"""Pinned schemas. Times of raw files are epoch nanoseconds held in a long.

Spark refuses to infer nanosecond timestamps from Parquet, so raw files are always
read with these schemas. Instants become TIMESTAMP_NTZ in UTC wall-clock time: no
session time zone can then move an observation across a day boundary.
"""

from pyspark.sql import types as T

# Column names, order and types of the raw files and of the messages.
MEASURES = ["u10", "v10", "d2m", "t2m", "msl", "sst", "sp", "tcc", "tciw", "tclw"]

_KEYS = [
    T.StructField("time", T.LongType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("number", T.LongType()),
    T.StructField("step", T.LongType()),
    T.StructField("surface", T.DoubleType()),
    T.StructField("valid_time", T.LongType()),
]

RAW_WEATHER = T.StructType(_KEYS + [T.StructField(m, T.FloatType()) for m in MEASURES])

RAW_RAIN = T.StructType(_KEYS + [T.StructField("tp", T.FloatType())])

MESSAGE = T.StructType(
    [
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("latitude", T.FloatType()),
        T.StructField("longitude", T.FloatType()),
        T.StructField("number", T.IntegerType()),
        T.StructField("step", T.StringType()),
        T.StructField("surface", T.FloatType()),
        T.StructField("valid_time", T.TimestampNTZType()),
    ]
    + [T.StructField(m, T.FloatType()) for m in MEASURES]
)

MESSAGE_SEPARATOR = ", "
MISSING_TEXT = "nan"
KEY_SEPARATOR = "_"
