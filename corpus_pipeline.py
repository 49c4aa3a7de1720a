"""Cleans documents for training in five stages.

Each stage takes (spark, docs, sf_dir), docs being what the stage before it kept, and all but the last return the columns
of documents; other columns are dropped. Between stages the documents are written as Parquet to the shared folder and read
again. Rows are judged one by one, by their texts: null and repeated ids do no harm, and null and empty texts go with the
first stage. An empty table stays empty in every stage. Very long texts are read whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import decontaminate, language, ngram_join, packing, substrings
from tributary.workspace import stored, temporary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts, those without a letter, those that fit no language and none best.

    lang is what the text says, unless that is ambiguous or unlike all that was learned: then a label stays, and only a
    null one is filled in. Without any labelled text all documents with a letter stay as they are.
    """
    model = language.train(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}")).select(COLUMNS)
    found = language.identify(docs, model, keep=["text", "lang", "source", "n_chars"])
    known = found.where((F.col("lang_pred") != language.UNKNOWN) & ~(F.col("ambiguous") & F.col("outside")))
    sure = ~F.col("ambiguous") & ~F.col("outside")
    return known.withColumn("lang", F.when(sure, F.col("lang_pred")).otherwise(F.coalesce("lang", "lang_pred"))).select(COLUMNS)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that five-word shingles link at 0.8 or more, the one with the smallest id stays.

    A null id is larger than all others; of equal ids that with the smallest text digest stays, and of equal rows one.
    """
    return ngram_join.one_of_each(docs).select(COLUMNS)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that a document with a smaller id has go; a document with nothing else goes too.

    A null id is larger than all others; rows with one id do not remove each other's passages. A text that loses words is what is left of it, joined by single spaces, and n_chars is set anew; others stay as are.
    """
    found = substrings.remove_repeats(docs, window=50, keep=["text", "lang", "source", "n_chars"])
    cut = F.col("n_removed") > 0
    text = F.when(cut, F.col("kept_text")).otherwise(F.col("text"))
    chars = F.when(cut, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return found.where(~cut | (F.col("n_removed") < F.col("n_words"))).withColumns({"text": text, "n_chars": chars}).select(COLUMNS)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go, each judged by its own text."""
    return decontaminate.leak_free(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens at most, one row for each piece, with its ids; repeated rows are packed each."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1).drop("loss")


STAGES = [
    ("language_id", identify_language),
    ("ngram_join", join_near_copies),
    ("substring_dedup", remove_repeats),
    ("decontamination", remove_benchmark),
    ("packing", pack),
]

#: Classifiers and tokenizers have no SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with temporary(spark):  # what a stage stores on its way goes with it
            docs = stored(stage(spark, docs, sf_dir), name, keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
