"""The operators bound to the tables, with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from memloom.llm import ann_scan, bpe_stream, decontaminate, hilbert_shards, jaccard_join, language_id, line_dedup, merkle, phrases, resample, secret_scan, token_files, toxicity
from memloom.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op3_ann_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_scan.neighbour_report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(documents(spark, sf_dir))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = token_files.Layout(public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.token_report(documents(spark, sf_dir), layout)


def op5_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_stream.bpe_report(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked_groups(documents(spark, sf_dir))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(spark, documents(spark, sf_dir))


def op8_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.quality_report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_report(documents(spark, sf_dir))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_token_files": op2_token_files,
    "op3_ann_scan": op3_ann_scan,
    "op4_line_dedup": op4_line_dedup,
    "op5_bpe_stream": op5_bpe_stream,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_secret_scan": op7_secret_scan,
    "op8_resample": op8_resample,
    "op9_language_id": op9_language_id,
    "op10_decontaminate": op10_decontaminate,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_hilbert_shards": hilbert_shards.op12_hilbert_shards,
    "op13_phrase_collocations": phrases.op13_phrase_collocations,
}

ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": r"""
        WITH lines AS (
            SELECT r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
            FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)
        ), keyed AS (
            SELECT r, doc_id, i, line,
                   translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ), gone AS (
            SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
            GROUP BY key HAVING count(DISTINCT r) >= 5
        )
        SELECT doc_id, count(*)::BIGINT AS n_lines,
               count(*) FILTER (WHERE last IS NOT NULL AND doc_id <> last)::BIGINT AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE last IS NULL OR doc_id = last), '')) AS kept_sha256
        FROM keyed LEFT JOIN gone USING (key)
        GROUP BY r, doc_id
    """,
    "op6_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 2, 2)), lambda k: array_to_string(w[k:k + 3], ' '))) AS s
            FROM words WHERE len(w) > 0
        ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
        reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, y FROM reach JOIN links ON r = x)
        SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(r) AS component_id FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
    """,
    "op10_decontaminate": r"""
        WITH words AS (
            SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
            UNION ALL
            SELECT 'i', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FROM benchmark
        ), shingles AS (
            SELECT DISTINCT side, id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda k: array_to_string(w[k:k + 4], ' '))) AS s
            FROM words WHERE len(w) > 0
        ), sizes AS (SELECT id, count(*) AS n FROM shingles WHERE side = 'i' GROUP BY id)
        SELECT d.id AS doc_id, i.id AS item_id, any_value(n)::BIGINT AS n_shingles, count(*)::BIGINT AS n_common,
               count(*)::DOUBLE / any_value(n) AS containment
        FROM shingles i JOIN shingles d ON i.s = d.s JOIN sizes ON sizes.id = i.id
        WHERE i.side = 'i' AND d.side = 'd'
        GROUP BY d.id, i.id HAVING count(*) >= 0.8 * any_value(n)
    """,
    "op11_merkle_manifest": merkle.SQL,
    "op13_phrase_collocations": phrases.SQL,
}
