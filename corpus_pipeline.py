"""A corpus pipeline: language, repeated lines, near copies, benchmark passages, tokens.

Each stage takes what the stage before it kept, as Parquet, and its decisions
take effect.  All stages but the last return the columns of documents.
Language identification can't be said in SQL, so ORACLE_SQL is None and
tests hold the pipeline against plain Python.

Defined cases: a text that is null, empty or without letters goes in the first
stage; a null lang or source stays; rows with one doc_id are separate documents
throughout, and of repeated rows the near-copy stage keeps one; an empty table
gives no rows; a very long text is taken whole by every stage; columns of the
documents' own keep their values, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memloom.llm import bpe_stream, decontaminate, jaccard_join, language_id, line_dedup
from memloom.llm.common import documents, free_name, written

#: A document whose likeliest language has less than this share is rejected.
MIN_SCORE = 0.5
TOKENIZER = "word_bpe_49k.json"


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network tells; those without letters or with no likely language go."""
    lang, score = free_name("lang_pred", docs), free_name("score", docs)
    told = language_id.identify(docs, language_id.fit(docs), lang_pred=lang, score=score)
    return told.where((F.col(lang) != language_id.UNKNOWN) & (F.col(score) >= MIN_SCORE)).select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that at least five hold, except in the last that does; n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs, n_lines=free_name("n_lines", docs), n_dropped=free_name("n_dropped", docs))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 0.8 over five-word shingles join."""
    return jaccard_join.keep_one(docs, words=5, percent=80).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item: less than 0.8 of any item's five-word shingles."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) and the text that they decode to."""
    coded = bpe_stream.encode_documents(docs, public_tokenizers.path(TOKENIZER))
    return coded.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language ID", identified),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("BPE encoding and decoding", encoded),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for documents."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return docs
