"""A registry of evaluation sets and readers of their queries and corpora."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from memloom.tables import written

QUERY_SCHEMA = "question string, labels array<string>, answer string"


@dataclass(frozen=True)
class Spec:
    """Where an evaluation set's queries and corpus are."""

    name: str
    query_path: str
    memory_path: str


class Registry:
    """Evaluation sets by name; an unknown name raises with those that are known."""

    def __init__(self, specs: list[Spec]):
        self.specs = {s.name: s for s in specs}

    def __getitem__(self, name: str) -> Spec:
        if name not in self.specs:
            raise ValueError(f"unknown evaluation set {name!r}; known are {', '.join(sorted(self.specs))}")
        return self.specs[name]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(s.name, s.query_path, s.memory_path) for s in self.specs.values()], "bench string, query_path string, memory_path string")

    def queries(self, spark: SparkSession, name: str) -> DataFrame:
        return read_queries(spark, self[name].query_path)

    def memory(self, spark: SparkSession, name: str) -> DataFrame:
        return read_memory(spark, self[name].memory_path)


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """question, labels, answer from a JSON list, or from Parquet, whose columns may be named query and reference_list."""
    if path.rstrip("/").endswith(".json"):
        return spark.read.schema(QUERY_SCHEMA).json(path, multiLine=True)
    if path.rstrip("/").endswith(".parquet"):
        rows = spark.read.parquet(path).withColumnsRenamed({"query": "question", "reference_list": "labels"})
        return rows.select("question", "labels", "answer")
    raise ValueError(f"queries are .json or .parquet, not {path!r}")


def read_json_list(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, text of a JSON list of strings, numbered from 0, read by as many tasks as the file has splits.

    The file is read as what stands between quotation marks, wherever splits
    fall.  A mark after an odd number of backslashes belongs to a text; how many
    others come before tells whether a piece is inside a text, and of which one.
    Marks are counted by split, and only the splits' counts, a row each, are
    summed in one window.  Pieces of a text, one but for escaped marks, meet by
    its number.  Anything but strings in the list is an error that says where.
    """
    read = spark.read.option("lineSep", '"').text(path)
    block = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    pieces = read.select(block.alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    slashes = F.length("value") - F.length(F.regexp_replace("value", r"\\+$", ""))
    pieces = written(pieces.withColumn("mark", (slashes % 2 == 0).cast("long")), "json")
    counts = pieces.groupBy("block").agg(F.sum("mark").alias("marks"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col("block").alias("of"), F.coalesce(F.sum("marks").over(before(Window.orderBy("block"))), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("mark").over(before(Window.partitionBy("block").orderBy("at"))), F.lit(0))
    placed = pieces.withColumn("k", inside).join(F.broadcast(bases), F.col("block") == F.col("of")).withColumn("k", F.col("k") + F.col("base"))
    number = F.floor(F.col("k") / 2)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "value"))), lambda x: x["value"]), '"')
    rows = placed.groupBy(number.alias("n"), (F.col("k") % 2).alias("said")).agg(text.alias("piece"))
    # Number n: what comes before text n, then text n.  The last of the former ends the list.
    last = rows.agg(F.max("n")).first()[0]
    if last is None or rows.where((F.col("n") == last) & (F.col("said") == 1)).count():
        raise ValueError(f"{path} isn't a list of texts: it ends before its bracket")
    between = F.when((F.col("n") == 0) & (F.col("n") == last), r"^\s*\[\s*\]\s*$").when(F.col("n") == 0, r"^\s*\[\s*$").when(F.col("n") == last, r"^\s*\]\s*$").otherwise(r"^\s*,\s*$")
    wrong = rows.where(F.col("said") == 0).where(~F.regexp_like("piece", between)).orderBy("n").limit(1).collect()
    if wrong:
        raise ValueError(f"{path} isn't a list of texts: before text {wrong[0]['n']} it has {wrong[0]['piece'][:80]!r}")
    listed = F.from_json(F.concat(F.lit('["'), "piece", F.lit('"]')), "array<string>", {"mode": "FAILFAST"})
    return rows.where("said = 1").select(F.col("n").cast("long").alias("doc_id"), F.get(listed, F.lit(0)).alias("text"))


def read_memory(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, text.  Parquet names ids itself; .jsonl holds one {"doc_id", "text"} object a line; .json is one list of texts, numbered from 0."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path).select(F.col("doc_id").cast("long"), "text")
    if path.rstrip("/").endswith(".json"):
        return read_json_list(spark, path)
    if path.rstrip("/").endswith(".jsonl"):
        return spark.read.schema("doc_id long, text string").json(path)
    raise ValueError(f"a corpus is .parquet, .json or .jsonl, not {path!r}")
