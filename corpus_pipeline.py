"""From raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the last return
the columns of ``documents``; ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandframe.llm import line_dedup, near_copies, packing, pii, toxicity
from demandframe.llm.common import fresh, materialise

#: Documents with this score or a higher one are rejected.
TOXIC = 0.7
#: Chunks that a worker of the packing stage remembers: few, as the stages after one another share an executor's memory.
KEPT = 200_000


def _counted(docs: DataFrame, like: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(like.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects toxic documents; the model learns from the labelled rows of the whole table."""
    model = toxicity.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = fresh(docs.columns, "score")[0]
    return toxicity.scored(docs, model, out=score).where(F.col(score) < TOXIC).select(docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes boilerplate lines; every document stays, and copied texts stay whole for the next stage."""
    return _counted(line_dedup.remove_boilerplate(docs, keep_copies=True), docs)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-copies."""
    return near_copies.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and the terms that give it away; every document stays."""
    return _counted(pii.sanitise(docs), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 0, with_ids=True, kept=KEPT)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_copy_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Fingerprints, hashed features and token ids have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
