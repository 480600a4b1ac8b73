"""Options of document memory: pooling, reductions, scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MemoryConfig:
    """pool: tokens of a chunk.  score: dot, scaled (by the square root of a head's width) or cosine."""

    pool: int = 64
    top_k: int = 16
    heads: int = 8
    head: str = "mean"
    query: str = "max"
    chunk: str = "max"
    score: str = "dot"

    def __post_init__(self) -> None:
        allowed = {"head": ("mean", "max"), "query": ("max", "mean", "last"), "chunk": ("max", "mean"), "score": ("dot", "scaled", "cosine")}
        for name, values in allowed.items():
            if getattr(self, name) not in values:
                raise ValueError(f"{name} must be one of {values}, not {getattr(self, name)!r}")


def read_config(spark: SparkSession, path: str, section: str) -> MemoryConfig:
    """The options that a model's JSON settings hold under `section`: how many documents, and tokens of a chunk.

    The number of documents is doc_top_k, or top_k_docs as some writers have
    it; what is missing keeps its default, and a file without the section is an error.
    """
    told = F.from_json(F.get_json_object("value", f"$.{section}"), "doc_top_k int, top_k_docs int, pooling_kernel_size int", {"mode": "FAILFAST"})
    row = spark.read.text(path, wholetext=True).select(told.alias("o")).select(F.coalesce("o.doc_top_k", "o.top_k_docs").alias("top_k"), F.col("o.pooling_kernel_size").alias("pool"), F.col("o").isNull().alias("none")).first()
    if row is None or row["none"]:
        raise ValueError(f"{path!r} has no {section!r}")
    return MemoryConfig(**{k: row[k] for k in ("top_k", "pool") if row[k] is not None})
