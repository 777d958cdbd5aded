"""Registered queries of the operators: each takes (spark, sf_dir), applies
one operator to its whole table and derives the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.llm import (
    bpe,
    ctw,
    edits,
    fingerprints,
    langid,
    licenses,
    minhash,
    mixing,
    packing,
    prefixtrie,
    spelling,
    suffixes,
    topk,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = langid.fold("doc_id", 4) == 2
    model = langid.train(docs.where(~held_out))
    return langid.identify(docs, model, ["doc_id", held_out.alias("held_out")])


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op7_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_documents(table(spark, sf_dir, "documents"), langid.fold("doc_id", 10) == 0, depth=6)


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document at least once, small sources up to twice."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.word_tokens().alias("n_tokens"), F.xxhash64("text").alias("text"))
    drawn = mixing.mix(docs, max_repeats=2.0, min_repeats=1.0, tokens=F.col("n_tokens"))
    return drawn.select("doc_id", "source", "draw.*")


def op10_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three edits of each text: a deletion at a third, its first 60
    characters inserted in the middle, ten characters replaced at a place that
    its crc32 chooses."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = F.length("text")
    edit = lambda at, removed, inserted: F.struct(
        at.cast("long").alias("at"), F.lit(removed).cast("long").alias("removed"), inserted.alias("inserted"))
    changes = F.array(edit(F.floor(n / 3), 40, F.lit("")), edit(F.floor(n / 2), 0, F.substring("text", 1, 60)),
                      edit(F.crc32(F.col("text").cast("binary")) % (n + 1), 10, F.lit(" edited here ")))
    return edits.count_edited(docs.withColumn("edits", changes))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_minhash_near_dedup, op2_license_scan, op3_language_id, op4_bpe_round_trip, op5_fingerprints,
    op6_suffix_array_dedup, op7_threshold_top_k, op8_lm_score, op9_source_mixing, op10_edit_aware_counts,
    op11_spelling_variants, op12_packing, op13_prefix_trie)}
