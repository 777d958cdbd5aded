"""Corpus pipeline: documents through the stages below, each a call of one
operator of ``starling.llm``. Every stage's result is written as Parquet to
the shared folder and reread as the next one's documents.

1. Language ID: rejected documents (no letter, or a narrow margin) go; a
   missing label becomes the predicted one.
2. MinHash near-dedup: one document of each group of near copies (shingles of
   five words, similarity of 0.8 or more) stays, the one of smallest id (of
   several texts under one id, the one whose hash is smallest).
3. Suffix-array dedup: bytes under any 100-byte string that also starts earlier
   go; a character cut by that goes as a whole.
4. Mixing: sources get tempered weights; every document is drawn at least
   once, those of small sources up to twice (a second draw is a second row).
5. BPE: number of tokens, digest of the ids and of the text decoded from them.

Defined cases: null and empty texts are rejected by stage 1; repeated rows of
one document count as near copies and one stays; a null doc_id is kept by every
stage but linked with nothing; an empty table gives no rows. Columns other than
those of documents, whatever their names, are carried to stage 4 in a struct.

SQL cannot express the stages (compression, minimum hashes, byte strings, merge
lists), so ``ORACLE_SQL`` is None; ``tests/llm`` holds the stages against
brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.llm import bpe, langid, minhash, mixing, suffixes
from starling.llm.common import row_keys
from starling.session import delete_path, shared_path


def packed(docs: DataFrame, *own: str) -> DataFrame:
    """The columns ``own`` and a struct of all others, so that no name of the
    others can clash with one of an operator."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    return docs.select(*own, *([F.struct(*others).alias("others")] if others else []))


def unpacked(rows: DataFrame, docs: DataFrame, *own: str) -> DataFrame:
    """The columns of ``docs`` again, in their order."""
    return rows.select(*(F.col(c) if c in own else F.col("others").getField(c).alias(c) for c in docs.columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3; learns from the labelled rows of its input."""
    own, model = ("doc_id", "text", "lang"), langid.train(docs)
    rows = packed(docs, *own)
    out = langid.identify(rows, model, rows.columns).where("NOT rejected")
    return unpacked(out.withColumn("lang", F.coalesce("lang", "lang_pred")), docs, *own)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1; the document with the smallest id of each group stays."""
    own = ("doc_id", "text")
    keyed = row_keys(packed(docs, *own))  # a doc_id with two texts is two documents
    found = minhash.near_duplicates(keyed.select(F.col("row_key").alias("doc_id"), "text"), shingle=5, percent=80)
    kept = found.where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("row_key")).distinct()
    left = keyed.join(kept, "row_key").dropDuplicates(["row_key"])
    return unpacked(left.unionByName(keyed.where("row_key IS NULL")), docs, *own)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6; the text becomes what is left of it."""
    own = ("doc_id", "text", "n_chars")
    left = suffixes.remove_repeats(packed(docs, *own), as_text=True).withColumn("text", F.col("kept"))
    return unpacked(left.withColumn("n_chars", F.length("text").cast("long")), docs, *own)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9; a row for each draw."""
    own = ("doc_id", "text", "source")
    return unpacked(mixing.mix(packed(docs, *own), max_repeats=2.0, min_repeats=1.0), docs, *own)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4."""
    return bpe.round_trip(docs)


STAGES = [
    ("language_id", identify_language),
    ("minhash_near_dedup", remove_near_copies),
    ("suffix_array_dedup", remove_repeated_passages),
    ("source_mixing", mix_sources),
    ("bpe_round_trip", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. A stage's folder is deleted as soon as
    the next one is written; the last one's stays for the reader."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root, before = shared_path(spark, "pipeline", unique=True), None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return docs
