"""The corpus pipeline: stages over ``documents``, each on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import line_dedup, packing, quality, simhash, toxicity
from barloom.llm.queries import BPE_JSON, table
from barloom.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality.apply_rules(docs, table(spark, sf_dir, "labels"), keep=COLUMNS)
    return judged.where("kept").select(*COLUMNS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    scored = toxicity.detect(docs, table(spark, sf_dir, "labels"), keep=COLUMNS)
    return scored.where("predicted = 0").select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that repeat elsewhere; n_chars follows the text."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash links: shingles of three words, two bits at most."""
    return simhash.keep_first(docs).select(*COLUMNS)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, BPE_JSON)


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("line dedup", line_stage),
    ("near duplicates", near_duplicate_stage),
    ("packing", pack_stage),
]
ORACLE_SQL = None  # models, fingerprints and tokens have no SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
