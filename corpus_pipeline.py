"""From raw documents to packed training sequences: the stages and the whole run.

Every stage but the last returns the columns of its documents, and works on all rows that the one
before it kept. Rows without an id are judged on their own and are never dropped for their id.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendspark.llm import language, line_dedup, mixing, near_dups, packing
from spendspark.llm.queries import tokenizer_file
from spendspark.session import materialise

# A document whose main language has a smaller share has none that could be said to be its own.
LEAST_SHARE = 0.4
# No source is used more often than this, and every document at least once.
MOST_REPEATS = 1.5
# Shingles of five words, similarity of 0.8 or more.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
SEQUENCE, END_ID = 4096, 1


def _columns(docs: DataFrame, **changed) -> list:
    """The columns of ``docs`` out of a struct ``doc``, with some of them changed."""
    return [changed[c].alias(c) if c in changed else F.col("doc").getField(c).alias(c) for c in docs.columns]


def _as_struct(docs: DataFrame):
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")


def detect_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or without a main language, go. All rows with a lang are learnt from.

    If no row has a lang, no language can be told and every document stays.
    """
    model = language.fit(docs, F.lit(True))
    if not model.languages:
        return docs
    judged = docs.select(_as_struct(docs), language.language_of(F.col("text"), model).alias("judged"))
    good = (F.col("judged.lang_pred") != language.UNKNOWN) & (F.col("judged.score") >= LEAST_SHARE)
    return judged.where(good).select(*_columns(docs))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least five documents share stay in one of them; text and n_chars follow."""
    lines = line_dedup.without_shared_lines(docs)
    lost = F.col("n_dropped") > 0
    text = F.when(lost, F.col("kept_text")).otherwise(F.col("doc.text"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        n_chars = F.when(lost, F.char_length("kept_text")).otherwise(F.col("doc.n_chars"))
        changed["n_chars"] = n_chars.cast(docs.schema["n_chars"].dataType)
    return lines.select(*_columns(docs, **changed))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    found = near_dups.near_duplicates(docs, k=SHINGLE_WORDS, percent=SIMILAR_PERCENT)
    copies = found.where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are flattened as far as none is repeated too often; repeated documents are repeated rows."""
    return mixing.mixed_rows(docs, max_repeats=MOST_REPEATS).select(*_columns(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"), END_ID, SEQUENCE)


STAGES = [
    ("language", detect_language),
    ("line_dedup", drop_shared_lines),
    ("near_dups", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Packing needs a tokenizer, which SQL has not; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
