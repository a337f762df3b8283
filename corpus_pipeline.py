"""From documents to packed sequences: quality, language, near duplicates, repeated passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import language, packing, quality, simhash, substrings
from tallyloom.llm.common import remove, stored, table, unused
from tallyloom.session import workspace

FOREIGN = 0.5  # phrases per byte from which on a text is in no learned language


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the labelled neighbours vote for; labels of every fifth fold teach nothing."""
    labels = table(spark, sf_dir, "labels").where(quality.fold("doc_id", 5) != 0)
    model = quality.fit_quality(docs, labels)
    score = unused(docs, "score")
    return quality.score_quality(docs, model, into=score).where(F.col(score) >= quality.THRESHOLD).drop(score)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus labels; those without letters, or whose text falls into phrases of two
    bytes or less even by the nearest language's text, go. The rule is the same for texts of any length."""
    samples = language.fit_languages(docs.where(F.coalesce(quality.fold("doc_id", 3), F.lit(0)) != 1))
    pred, score, rate = unused(docs, "lang_pred"), unused(docs, "score"), unused(docs, "rate")
    found = language.identify(docs, samples, lang_into=pred, score_into=score, rate_into=rate)
    return found.where((F.col(pred) != language.UNKNOWN) & (F.col(rate) < FOREIGN)).drop(pred, score, rate)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: those whose SimHash fingerprints (op1's, of three-word shingles) differ in 3 bits
    or fewer are linked, and those whose sets of five-word shingles are verified to have a similarity of 0.8 or more."""
    return simhash.near_duplicates(docs, bits=3)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also stand elsewhere; texts that lose nothing stay as they are."""
    rows = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("body"), F.struct("*").alias("row"))
    found = substrings.remove_repeats(rows, "id", "body", carry=("row",))
    text = F.when(F.col("n_removed") == 0, F.col("row.text")).otherwise(F.col("kept"))
    fresh = {"text": text, "n_chars": F.length(text).cast("long")}
    return found.select(*[fresh.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids in sequences of 2048."""
    found = packing.pack(docs)
    return found.select(F.col("id").alias("doc_id"), "start", "length", "ids", F.crc32("ids").alias("ids_crc32"),
                        "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_duplicates", without_near_copies),
    ("repeats", without_repeats),
    ("packing", packed),
]

# Votes, automata and vocabularies are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each on the written result of the one before.

    What a stage wrote for itself goes once its result is written, and that once the next one's is.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with workspace(spark) as kept:
            docs, path = stored(stage(spark, docs, sf_dir), f"pipeline-{name}", named=True)
            kept.add(path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
