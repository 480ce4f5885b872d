"""Registered queries of this subpackage: thin contracts over its operators."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendspark.llm import centroids, embeddings, language, line_dedup, mixing, near_dups, packing, quality_gam, quality_rules
from spendspark.llm import spelling, syncmers, token_files, toxicity
from spendspark.session import materialise, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def tokenizer_file(name: str) -> str:
    """A public tokenizer's file; the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(fold("id", 4) == 2, F.lit(False))
    feats = materialise(quality_gam.text_features(table(spark, sf_dir, "documents")), "quality-features")
    model = quality_gam.fit(feats, table(spark, sf_dir, "labels"), ~held_out, "quality")
    scored = quality_gam.score(feats, model)
    return scored.select(
        F.col("id").alias("doc_id"), held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    model = language.fit(docs, ~held_out)
    return language.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs, entropy_share=0.97, max_repeats=4.0)
    return mixed.select("doc_id", "source", mixing.token_count(F.col("text")).alias("n_tokens"), "mix_copy", "mix_order")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(
        table(spark, sf_dir, "documents"), path, tokenizer_file("byte_bpe_50k.json"), end_id=2
    )
    stored = token_files.read_token_files(spark, path)
    summed = stored.select("doc_id", "part", "start_in_part", "n_tokens", token_files.ids_crc32("ids").alias("ids_crc32"))
    return token_files.with_positions(summed).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), F.coalesce(fold("id", 3) == 1, F.lit(False))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = toxicity.score_documents(docs, model)
    return scored.select(
        F.col("id").alias("doc_id"), held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=1, capacity=4096
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256, salt="2:")
    return centroids.with_inertia(found).select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op12_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.against_edits(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_gam": op1_quality_gam,
    "op2_language": op2_language,
    "op3_embeddings": op3_embeddings,
    "op4_mixing": op4_mixing,
    "op5_token_files": op5_token_files,
    "op6_quality_rules": op6_quality_rules,
    "op7_near_dups": op7_near_dups,
    "op8_toxicity": op8_toxicity,
    "op9_packing": op9_packing,
    "op10_line_dedup": op10_line_dedup,
    "op11_centroids": op11_centroids,
    "op12_syncmers": op12_syncmers,
    "op13_spelling": op13_spelling,
}
