"""The registered queries of the training-data operators, with the SQL they are checked against."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adsieve.llm import jaccard_join, language, line_quality, merkle, mixing, neighbours, packing, simhash, suffix_dedup, tool_calls, url_lists, whitening, word_windows

PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.where(F.col("vec_id") % 20 == 0), neighbours.fit(vectors))


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_calls.turns_as_calls(table(spark, sf_dir, "conversations"))
    return tool_calls.link(calls, results, tool_calls.TURN_SCHEMAS)


def op5_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_lists.judge(*url_lists.demonstration(table(spark, sf_dir, "pages")), suffixes=url_lists.SUFFIXES)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.select("doc_id", "text", "lang"), PIECES)
    found = language.predict(docs, PIECES, model)
    return found.select("doc_id", language.is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_word_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = word_windows.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_quality.judge(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs, max_repeats=2.0)
    return mixed.select("doc_id", "source", F.col("mix_tokens").alias("n_tokens"), F.col("mix_weight").alias("weight"), F.col("mix_epoch").alias("epoch"), F.col("mix_block").alias("block"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    altered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return merkle.manifest(docs, tampered=F.when(altered, F.replace("text", F.lit("\n"))).otherwise(F.col("text")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {"op1_packing": op1_packing, "op2_suffix_dedup": op2_suffix_dedup, "op3_neighbours": op3_neighbours, "op4_tool_calls": op4_tool_calls, "op5_url_lists": op5_url_lists, "op6_language": op6_language, "op7_word_windows": op7_word_windows, "op8_line_quality": op8_line_quality, "op9_mixing": op9_mixing, "op10_jaccard_join": op10_jaccard_join, "op11_simhash": op11_simhash, "op12_merkle": op12_merkle, "op13_whitening": op13_whitening}
ORACLE_SQL = {"op2_suffix_dedup": suffix_dedup.ORACLE, "op10_jaccard_join": jaccard_join.ORACLE, "op7_word_windows": word_windows.ORACLE, "op4_tool_calls": tool_calls.ORACLE, "op5_url_lists": url_lists.ORACLE, "op8_line_quality": line_quality.ORACLE, "op12_merkle": merkle.ORACLE}
