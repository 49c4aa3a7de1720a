"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from tributary.llm import decontaminate, language, lexical, lm, neighbours, ngram_join, oracles, packing, quality, shards, substrings, token_files, urls, whitening
from tributary.workspace import new_path, stored

URL_RULES = [("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shards.shuffle_into_shards(table(spark, sf_dir, "documents"), 24)
    return shards.shard_digest(shards.write_shards(sharded, new_path(spark, "shards")))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_similar(table(spark, sf_dir, "documents"), k=5, percent=80)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = urls.train(urls.labelled_table(spark))
    judged = urls.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES, model)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.col("block_score"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"), window=50)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = stored(quality.measure(table(spark, sf_dir, "documents")), "measured")
    forest = quality.train(measured, table(spark, sf_dir, "labels"))
    return quality.judge(measured, forest).select("doc_id", *quality.COUNTS, "base_failed", "kept", "anomaly")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "token-files")
    path = public_tokenizers.path("byte_bpe_50k.json")
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), folder, path, end_id=2, width=2)
    return token_files.read_token_files(manifest, folder)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language.held_out_third("doc_id")
    model = language.train(docs.where(~held_out))
    found = language.identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), path, end_id=1)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def conversation_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9 for instruction data: only the assistant's turns bear loss, and all three limits bind."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_turns(table(spark, sf_dir, "conversations"), path, end_id=1).drop("ids")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), held_out=lm.held_out_tenth("doc_id"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), components=32)
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


QUERIES = {
    "op1_shards": op1_shards,
    "op2_ngram_join": op2_ngram_join,
    "op3_url_filter": op3_url_filter,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_quality": op5_quality,
    "op6_token_files": op6_token_files,
    "op7_decontaminate": op7_decontaminate,
    "op8_language_id": op8_language_id,
    "op9_packing": op9_packing,
    "op10_lm_score": op10_lm_score,
    "op11_whitening": op11_whitening,
    "op12_lexical_search": op12_lexical_search,
    "op13_neighbours": op13_neighbours,
    "conversation_packing": conversation_packing,
}

#: SQL for the queries that it can express.
ORACLE_SQL: dict[str, str] = {"op2_ngram_join": oracles.OP2, "op4_substring_dedup": oracles.OP4, "op7_decontaminate": oracles.OP7, "op12_lexical_search": oracles.OP12}
