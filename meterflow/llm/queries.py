"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from meterflow.llm import (bpe, cover_tree, hard_negatives, language_id, licenses, line_spread, minhash, mixing, quality_model,
                           quality_rules, substrings, toxicity, turn_repair)

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return add


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register("op1_cover_tree_near_dedup")
def op1(spark, sf_dir):
    """Links and components of embeddings at cosine 0.9."""
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"), 0.9)


@register("op2_bpe")
def op2(spark, sf_dir):
    """Ids and decoded texts of all documents, as digests."""
    return bpe.encoded(table(spark, sf_dir, "documents"), corpus_pipeline.TOKENIZER, with_ids=False)


@register("op3_language_id")
def op3(spark, sf_dir):
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs))


@register("op4_license_scan")
def op4(spark, sf_dir):
    """The licence of every document; its path is source/lang/doc_id.txt."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licenses.scan(docs.select("doc_id", path.alias("path"), "text"))


@register("op5_quality_rules", quality_rules.ORACLE_SQL)
def op5(spark, sf_dir):
    """Counts and verdicts of the line rules."""
    rows = quality_rules.line_rules(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", *quality_rules.COUNTS, *quality_rules.FLAGS)


@register("op6_quality_classifier")
def op6(spark, sf_dir):
    """Scores of the weakly supervised quality model."""
    docs = table(spark, sf_dir, "documents")
    return quality_model.score(docs, quality_model.fit(docs))


@register("op7_line_dedup", line_spread.ORACLE_SQL)
def op7(spark, sf_dir):
    """Lines on five sites or more, removed; the cleaned text as a digest."""
    clean = line_spread.drop_spread_lines(table(spark, sf_dir, "documents"), "source", min_sites=5)
    return clean.select("doc_id", "n_lines", "n_spread", "n_removed", "removed_chars", F.sha2("text", 256).alias("text_sha256"))


@register("op8_toxicity")
def op8(spark, sf_dir):
    """Toxicity of every document by its nearest labelled examples."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@register("op9_mixing")
def op9(spark, sf_dir):
    """How often the mix takes each document, and into which shards."""
    return mixing.draws(table(spark, sf_dir, "documents"))


@register("op10_minhash_near_dedup")
def op10(spark, sf_dir):
    """Components of documents linked at Jaccard 0.85 on 3-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85, bands=25, rows=5)


@register("op11_conversation_repair", turn_repair.ORACLE_SQL)
def op11(spark, sf_dir):
    """Cheapest repairs of the conversations after the damage that the contract states."""
    return turn_repair.repair(turn_repair.damaged(table(spark, sf_dir, "conversations"))).summary()


@register("op12_substring_dedup", substrings.ORACLE_SQL)
def op12(spark, sf_dir):
    """Passages of 35 words that stand twice, removed; what is left as a digest."""
    rows = substrings.drop_repeats(table(spark, sf_dir, "documents"), 35, digest=True)
    return rows.select("doc_id", "n_words", "n_removed", "kept_sha256")


@register("op13_hard_negatives", hard_negatives.ORACLE_SQL)
def op13(spark, sf_dir):
    """Hard negatives of every hundredth vector; the label of every seventh is off by one."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    off = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", off), F.col("vec_id") % 100 == 0)


@register("pipeline")
def pipeline(spark, sf_dir):
    """All stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, sf_dir)
