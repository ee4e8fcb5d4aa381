"""The corpus pipeline: documents to token ids in five stages.

Every stage takes the whole output of the one before and is written as Parquet
in the shared folder and read again, so a lost executor repeats work of one
stage at most. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import bpe, line_spread, minhash, mixing, quality_model
from meterflow.llm.scratch import saved

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised scorer keeps; texts without words go."""
    return quality_model.keep_good(docs, quality_model.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand on five sites or more; n_chars follows the text."""
    clean = line_spread.drop_spread_lines(docs, "source", min_sites=5)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return clean.select(*docs.columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group linked at 0.8 on 5-word shingles."""
    groups = minhash.near_duplicates(docs, k=5, percent=80, bands=32, rows=4)
    return docs.join(groups.filter("not kept").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as drawn, in shards, shuffled within them."""
    return mixing.mixed(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids of every row of the mix."""
    return bpe.encoded(docs, TOKENIZER)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("mixing_sources", mixing_sources),
    ("bpe_encoding", bpe_encoding),
]

#: Random draws and the fitted scorer can't be stated in SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
