"""Sources, snapshots, results, rounds and streams over the tables: what is written is read again, what is streamed is answered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memloom.functions import text
from memloom.operators import interleave, prompts
from memloom.plans import routing
from memloom.sources import registry, snapshots
from memloom.streaming import requests
from memloom.tables import scratch

#: When all parts of the streams here were sent.
SENT = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def evaluation_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as an evaluation set: found by name in a registry, read under its other column names, checked."""
    path = scratch(spark, "set")
    items = table(spark, sf_dir, "benchmark")
    labels = F.array(F.concat(F.lit("item "), F.col("item_id")), F.element_at(F.split("text", " "), 1))
    items.select(F.col("text").alias("query"), labels.alias("reference_list"), F.element_at(F.split("text", " "), -1).alias("answer")).write.parquet(f"{path}/queries.parquet")
    known = registry.Registry([registry.Spec("items", f"{path}/queries.parquet", f"{sf_dir}/documents.parquet")])
    asked = prompts.checked(known.queries(spark, "items"), "question", text.token_count(F.col("question")), 1 << 20)
    return asked.select("question", F.element_at("labels", 1).alias("label"), F.size("labels").cast("long").alias("n_labels"), "answer")


def corpus_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a corpus of JSON lines, read through a registry."""
    path = scratch(spark, "corpus")
    table(spark, sf_dir, "documents").select("doc_id", "text").write.json(f"{path}/memory.jsonl")
    known = registry.Registry([registry.Spec("all", f"{sf_dir}/benchmark.parquet", f"{path}/memory.jsonl")])
    return known.memory(spark, "all").select("doc_id", F.sha2("text", 256).alias("text_sha256"))


def memory_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as memory of three layers: the first call builds the snapshot, the second must find it whole."""
    rows = routing.chunks(spark, sf_dir).withColumn("layer", (F.col("chunk_id") % 3).cast("int"))
    path = f"{scratch(spark, 'memory')}/{snapshots.snapshot_key('embeddings', 'given', routing.BASE)}"
    n_docs = rows.select("doc_id").distinct().count()
    snapshots.memory_or_build(spark, path, lambda: rows, n_docs)

    def again() -> DataFrame:
        raise RuntimeError(f"the snapshot at {path} isn't found")

    held = snapshots.memory_or_build(spark, path, again, n_docs)
    total = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x)
    return held.select(F.col("layer").cast("long").alias("layer"), "doc_id", "chunk_id", F.round(total, 6).alias("total"))


def results_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of all turns, a case for each role; then those of users are run again and replace theirs alone."""
    path = scratch(spark, "results")
    turns = table(spark, sf_dir, "conversations").select(F.coalesce("role", F.lit("none")).alias("case"), "conv_id", "turn", F.length("text").cast("long").alias("n"))
    snapshots.upsert_results(turns.withColumn("run", F.lit(1).cast("long")), path)
    snapshots.upsert_results(turns.where(F.col("case") == "user").withColumns({"run": F.lit(2).cast("long"), "n": F.col("n") + 1}), path)
    return snapshots.read_results(spark, path).select("case", "conv_id", "turn", "n", "run")


def judged_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns judged by their length, written with their mean, and read as reports do."""
    path = scratch(spark, "judged")
    turns = table(spark, sf_dir, "conversations")
    asked = F.concat_ws("/", "conv_id", "turn")
    records = turns.select(asked.alias("question"), F.col("text").alias("true_answer"), F.left("text", F.lit(9)).alias("pred_answer"), (F.length("text") % 6).cast("double").alias("pred_score"))
    mean = snapshots.write_judged(records, path)
    held = spark.read.schema("question string, true_answer string, pred_answer string, pred_score double").json(f"{path}/records")
    return held.select("question", F.sha2("true_answer", 256).alias("true_sha256"), "pred_answer", "pred_score", F.lit(round(mean, 6)).alias("mean_score"))


def said(state: DataFrame) -> DataFrame:
    """A generator that shows the flow: by turns it answers at once, cites a document, or ends retrieval; once asked again it answers by its whole prompt."""
    q, prompt = F.col("query_id"), F.col("prompt")
    answer = F.concat(F.lit(f"{text.ANSWER} "), F.sha2("prompt", 256))
    cites = F.concat(F.lit("["), (q % 1000).cast("string"), F.lit(f"]{text.OBJECT_END}"))
    first = F.when(q % 3 == 0, answer).when(q % 3 == 1, cites).otherwise(text.RETRIEVE_END)
    return state.withColumn("out", F.when(prompt.contains(text.REGENERATE), answer).otherwise(first))


def interleaved_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds of retrieval and answers for each turn: cited documents, or the question once more, are in what is asked next."""
    prompt = F.concat(F.lit(text.HISTORY), "text", F.lit(f"\n{text.REQUEST}"))
    asked = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), prompt.alias("prompt"))
    return interleave.interleave(asked, table(spark, sf_dir, "documents"), said, scratch(spark, "rounds"), most=4)


def response_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as parts of responses that come in files of their own; each conversation is given once, when all are there."""
    path = scratch(spark, "parts")
    turns = table(spark, sf_dir, "conversations")
    n = turns.groupBy("conv_id").agg(F.count_distinct("turn").alias("n"))
    parts = turns.join(n, "conv_id").select("conv_id", "turn", "n", "text", F.lit(SENT).cast("timestamp").alias("ts"))
    parts.repartition(6, "turn").write.parquet(f"{path}/in")
    stream = requests.request_stream(spark, f"{path}/in", "conv_id long, turn long, n long, text string, ts timestamp", files=3)
    requests.appended(requests.gathered(stream, "conv_id", "turn", "n", "text"), f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.parquet(f"{path}/out").select("conv_id", F.size("parts").cast("long").alias("n"), F.sha2(F.array_join("parts", "|"), 256).alias("text_sha256"))


def routed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query tokens as a stream, those of a query in files of their own; each query is routed once over all of memory."""
    path = scratch(spark, "requests")
    asked = routing.tokens(spark, sf_dir)
    n = asked.groupBy("query_id").agg(F.count("*").alias("n"))
    parts = asked.join(n, "query_id").select("query_id", "tok", "n", "vec", F.lit(SENT).cast("timestamp").alias("ts"))
    parts.repartition(6, "tok").write.parquet(f"{path}/in")
    stream = requests.request_stream(spark, f"{path}/in", requests.REQUESTS, files=3)
    requests.serve(stream, routing.chunks(spark, sf_dir), routing.BASE, f"{path}/out", f"{path}/state").awaitTermination()
    return routing.rounded(spark.read.parquet(f"{path}/out"))


QUERIES = {f.__name__: f for f in (evaluation_set, corpus_scan, memory_snapshot, results_upsert, judged_results, interleaved_rounds, response_stream, routed_stream)}
ORACLE_SQL = {
    "evaluation_set": "SELECT text AS question, 'item ' || item_id AS label, 2::BIGINT AS n_labels, string_split(text, ' ')[-1] AS answer FROM benchmark",
    "corpus_scan": "SELECT doc_id, sha256(text) AS text_sha256 FROM documents",
    "memory_snapshot": "SELECT vec_id % 3 AS layer, vec_id // 8 AS doc_id, vec_id AS chunk_id, round(list_sum(embedding::DOUBLE[]), 6) AS total FROM embeddings",
    "results_upsert": """
        SELECT coalesce(role, 'none') AS "case", conv_id, turn, length(text) + (coalesce(role, '') = 'user')::BIGINT AS n, 1 + (coalesce(role, '') = 'user')::BIGINT AS run
        FROM conversations""",
    "judged_results": """
        SELECT conv_id || '/' || turn AS question, sha256(text) AS true_sha256, left(text, 9) AS pred_answer, (length(text) % 6)::DOUBLE AS pred_score,
               round(avg(length(text) % 6) OVER (), 6) AS mean_score FROM conversations""",
    "interleaved_rounds": """
        WITH q AS (SELECT conv_id * 1000 + turn AS query_id, text, 'historical document information' || chr(10) || chr(10) || text || chr(10) || 'Please return all documents related to the question' AS p FROM conversations),
        o AS (SELECT *, '[' || query_id % 1000 || ']<|object_ref_end|>' AS cites FROM q),
        n AS (SELECT o.query_id, CASE query_id % 3 WHEN 0 THEN p
                     WHEN 1 THEN p || '<regenerate>' || cites || coalesce('[' || d.doc_id || ']. ' || d.text || chr(10), '') || '<|object_ref_end|>'
                     ELSE p || '<regenerate><End-of-Retrieve><|im_start|>The user''s question is: ' || o.text || chr(10) || '<|object_ref_end|>' END AS last
              FROM o LEFT JOIN documents d ON d.doc_id = o.query_id % 1000)
        SELECT query_id, CASE WHEN query_id % 3 = 0 THEN 1 ELSE 2 END::BIGINT AS rounds, 'The answer to the question is: ' || sha256(last) AS out FROM n""",
    "response_stream": "SELECT conv_id, count(*)::BIGINT AS n, sha256(string_agg(text, '|' ORDER BY turn)) AS text_sha256 FROM conversations GROUP BY conv_id",
    "routed_stream": routing.top_sql(routing.BASE),
}
