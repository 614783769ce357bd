"""The corpus pipeline: quality rules, line dedup, near-dedup, source mixing, packing.

``run`` applies the stages to ``documents``; each stage's result is written as
Parquet under the session's scratch folder and read again by the next. Rows
equal in ``doc_id`` and text are one document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.lines import drop_repeated_lines
from cartwheel.llm.minhash import near_documents
from cartwheel.llm.mixing import mix, word_count
from cartwheel.llm.packing import pack
from cartwheel.llm.quality import MIN_WORDS, quality_scores
from cartwheel.llm.scratch import Scratch


def _boxed(docs: DataFrame) -> Column:
    """A whole row as one struct: columns of any name pass through a stage without meeting its own."""
    return F.struct(*["`" + c.replace("`", "``") + "`" for c in docs.columns])


def _with(docs: DataFrame, wanted: DataFrame, once: bool = False) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` and text are in ``wanted(doc_id, text_hash)``; ``once``: without repeats."""
    boxed = docs.select(_boxed(docs).alias("row"), F.col("doc_id").alias("d"), F.xxhash64("text").alias("h"))
    keys = wanted.select(F.col("doc_id").alias("wd"), F.col("text_hash").alias("wh")).distinct()
    rows = boxed.join(keys.hint("merge"), F.col("d").eqNullSafe(F.col("wd")) & (F.col("h") == F.col("wh")), "left_semi")
    if once:
        rows = rows.dropDuplicates(["d", "h"])
    return rows.select("row.*")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return _with(docs, quality_scores(docs).filter("kept"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, later copies of repeated runs of lines deleted from their texts.

    A document that loses lines and keeps fewer words than the quality rules
    ask for goes: what is left of it is a scrap. Unchanged documents stay.
    """
    return drop_repeated_lines(docs, least_left=MIN_WORDS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return _with(docs, near_documents(docs).filter("kept"), once=True)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    rows = docs.select(_boxed(docs).alias("row"), "doc_id", F.array("source").alias("sources"), word_count(F.col("text")).alias("words"), F.xxhash64("text").alias("text_hash"))
    mixed = mix(rows, F.col("sources"), size=F.col("words"), tie=F.col("text_hash")).filter("mix.copies > 0")
    copies = mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("mix.copies").cast("int"))).alias("nth"))
    return copies.select("row.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in sequences."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("near dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the divergence verdict's sketches nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.table(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            scratch.drop(f"stage-{k - 1}")
    return docs
