"""The operators as stages: documents in, documents of the same columns out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridgale.llm import line_dedup, mixing, near_dedup, packing, toxicity
from gridgale.llm.common import as_stage, packed, unpacked


def _with_text(rows: DataFrame, text: Column) -> DataFrame:
    """The documents with another text, and its length where they say one."""
    changes = {"text": text}
    if "n_chars" in rows.schema["row"].dataType.fieldNames():
        changes["n_chars"] = F.length(text).cast(rows.schema["row"].dataType["n_chars"].dataType)
    return unpacked(rows, **changes)


@as_stage
def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the table `labels`, doesn't take for toxic."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return unpacked(toxicity.score_documents(docs, model).where("score < 0.5").select("row"))


@as_stage
def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that other ones keep; a text may end up empty."""
    deduped = line_dedup.drop_repeated_lines(docs)
    return _with_text(deduped, F.col("kept_text"))


@as_stage
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id, and of rows that repeat
    it the one with the smallest text. Rows with a null id all stay."""
    kept = near_dedup.near_duplicates(docs).where("kept AND id IS NOT NULL").select("id").distinct()
    rows = packed(docs).withColumn("id", F.col("row.doc_id"))
    first = F.row_number().over(Window.partitionBy("id").orderBy(F.col("row.text").asc_nulls_last()))
    chosen = rows.join(kept, "id").withColumn("_first", first).where("_first = 1").select("row")
    return unpacked(chosen.unionByName(rows.where("id IS NULL").select("row")))


@as_stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes; a document that it takes twice comes twice."""
    drawn = mixing.mixed_texts(mixing.mix_sources(docs))
    if "n_chars" not in drawn.columns:
        return drawn
    return drawn.withColumn("n_chars", F.length("text").cast(drawn.schema["n_chars"].dataType))


@as_stage
def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their place in the packed sequences."""
    return packing.pack_documents(docs, carry=["doc_id"]).select(
        "row.doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
