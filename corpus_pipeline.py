"""The corpus pipeline: quality, repeated lines, near copies, mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sonde.llm import line_dedup, mixing, packing, quality, simhash
from sonde.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled rows of `docs`, doesn't reject."""
    return quality.quality_filter(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat others; what has no text left after that goes."""
    rows = line_dedup.line_dedup(docs)
    return rows.where("`__removed` = 0 or trim(text) <> ''").select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash links, as op8 has them."""
    return simhash.simhash_dedup(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as their source's target takes them."""
    return mixing.mixed_documents(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, ids included, with their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [("quality", quality_stage), ("lines", line_stage), ("near_copies", near_stage), ("mix", mix_stage), ("pack", pack_stage)]

#: SQL can express neither the classifier nor SimHash nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
