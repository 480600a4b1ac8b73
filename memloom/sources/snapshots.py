"""Snapshots of pooled memory, by layer, and results by case."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from memloom.config import MemoryConfig

MEMORY = "layer int, doc_id long, chunk_id long, vec array<double>"


def snapshot_key(corpus: str, encoder: str, config: MemoryConfig) -> str:
    """Names a snapshot by what determines it."""
    said = json.dumps([corpus, encoder, config.pool, config.heads])
    return hashlib.sha256(said.encode()).hexdigest()[:16]


def write_memory(memory: DataFrame, path: str) -> None:
    """Rows of layer, doc_id, chunk_id and vectors (one, or k, v and rk), one folder for each layer, then what the snapshot holds."""
    memory.write.mode("overwrite").partitionBy("layer").parquet(f"{path}/rows")
    rows = memory.sparkSession.read.parquet(f"{path}/rows")
    held = rows.agg(F.count_distinct("doc_id").alias("n_docs"), F.count_distinct("layer").alias("n_layers"), F.count("*").alias("n_rows"))
    held.coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def read_memory(spark: SparkSession, path: str, layers: list[int] | None = None, columns: list[str] | None = None) -> DataFrame:
    """All of a snapshot, or some layers and vectors; other layers' files and other columns aren't read, so that routing reads rk alone."""
    rows = spark.read.parquet(f"{path}/rows")
    rows = rows if columns is None else rows.select("layer", "doc_id", "chunk_id", *columns)
    return rows if layers is None else rows.where(F.col("layer").isin(layers))


def place_memory(memory: DataFrame, path: str, rows_per_file: int = 1 << 16) -> None:
    """Rows of doc_id, chunk_id and vectors laid out by document: each whole in one file, with n_chunks, files by ranges of ids, and a manifest of these."""
    files = max(1, -(-memory.count() // rows_per_file))
    rows = memory.repartitionByRange(files, "doc_id").withColumn("n_chunks", F.count("*").over(Window.partitionBy("doc_id")))
    rows.sortWithinPartitions("doc_id", "chunk_id").write.mode("overwrite").parquet(f"{path}/placed")
    placed = memory.sparkSession.read.parquet(f"{path}/placed")
    held = placed.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n"))
    held.write.mode("overwrite").parquet(f"{path}/manifest")


def read_placed(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Ids, n_chunks and some vectors of all of memory."""
    return spark.read.parquet(f"{path}/placed").select("doc_id", "chunk_id", "n_chunks", *columns)


def fetch_placed(spark: SparkSession, path: str, wanted: DataFrame, *columns: str) -> DataFrame:
    """Ids and some vectors of the chunks of wanted documents (doc_id), read from the files that may hold them and no others."""
    # A row a file.
    files = sorted((r["least"], r["most"], r["file"]) for r in spark.read.parquet(f"{path}/manifest").collect())
    least, most = (np.array([f[k] for f in files], dtype=np.int64) for k in (0, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).drop_null().to_numpy()
            at = np.searchsorted(least, ids, "right") - 1
            held = (at >= 0) & (ids <= most[np.maximum(at, 0)]) if len(least) else np.zeros(len(ids), dtype=bool)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(at[held]))], names=["file"])

    ids = wanted.select(F.col("doc_id").cast("long"))
    chosen = [r["file"] for r in ids.mapInArrow(run, "file long").distinct().collect()]
    kind = spark.read.parquet(f"{path}/placed").schema
    rows = spark.read.schema(kind).parquet(*[f"{path}/placed/{files[k][2]}" for k in sorted(chosen)]) if chosen else spark.createDataFrame([], kind)
    return rows.select("doc_id", "chunk_id", *columns).join(ids.distinct(), "doc_id", "left_semi")


def memory_or_build(spark: SparkSession, path: str, build, n_docs: int | None = None) -> DataFrame:
    """Reads the snapshot at path; builds and writes it first if there is none that is whole.  Another number of documents is an error."""
    try:
        meta = spark.read.schema("n_docs long").json(f"{path}/meta")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        write_memory(build(), path)
        meta = spark.read.schema("n_docs long").json(f"{path}/meta")
    held = meta.first()[0]
    if n_docs is not None and held != n_docs:
        raise ValueError(f"the snapshot at {path} holds {held} documents, not {n_docs}")
    return read_memory(spark, path)


def upsert_results(results: DataFrame, path: str) -> None:
    """Writes rows with a column `case`; cases that are there already are replaced, others stay."""
    results.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("case").json(path)


def write_judged(records: DataFrame, path: str) -> float:
    """Writes a case's judged records (question, true_answer, pred_answer, pred_score) and returns their mean score; the answers' own files stay as they are."""
    records.select("question", "true_answer", "pred_answer", "pred_score").write.mode("overwrite").json(f"{path}/records")
    score = records.sparkSession.read.schema("pred_score double").json(f"{path}/records").agg(F.avg("pred_score")).first()[0] or 0.0
    records.sparkSession.createDataFrame([(float(score),)], "score_mean double").write.mode("overwrite").json(f"{path}/score")
    return float(score)


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """file, question, true_answer, pred_answer of the answers in {"anonymous": {"precision": [...]}} of every .json file but score files."""
    kind = "anonymous struct<precision: array<struct<question: string, true_answer: string, pred_answer: string>>>"
    rows = spark.read.schema(kind).json(path, multiLine=True, pathGlobFilter="*.json").select(F.col("_metadata.file_name").alias("file"), "anonymous")
    return rows.where(~F.col("file").contains("score")).select("file", F.inline("anonymous.precision"))


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Results of all files but score files, with the file's name."""
    rows = spark.read.json(path, recursiveFileLookup=False).withColumn("file", F.input_file_name())
    return rows.where(~F.col("file").rlike("score[^/]*$"))
