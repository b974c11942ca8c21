"""A corpus from raw documents to packed sequences: stages over the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridgale.llm import stages
from gridgale.llm.common import documents, remove
from gridgale.session import shared_path

STAGES = [
    ("toxicity", stages.clean),
    ("line_dedup", stages.without_shared_lines),
    ("near_dedup", stages.without_near_copies),
    ("mixing", stages.mixed),
    ("packing", stages.sequences),
]
# A trained classifier and token ids are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written to the shared folder and read again by the next; then what it read goes."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
