"""Routing over embeddings: chunks are all rows, eight to a document; query tokens are the rows whose id is divisible by 100, three to a query."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memloom.config import MemoryConfig
from memloom.functions import vectors
from memloom.operators import corpora, hooks, readout, routing
from memloom.sources import snapshots
from memloom.tables import scratch

BASE = MemoryConfig()


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return rows.select(F.floor(F.col("vec_id") / 8).cast("long").alias("doc_id"), F.col("vec_id").alias("chunk_id"), vectors.doubles(F.col("embedding")).alias("vec"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where("vec_id % 100 = 0")
    number = F.floor(F.col("vec_id") / 100).cast("long")
    return rows.select(F.floor(number / 3).cast("long").alias("query_id"), (number % 3).alias("tok"), vectors.doubles(F.col("embedding")).alias("vec"))


def rounded(df: DataFrame) -> DataFrame:
    return df.select("query_id", "doc_id", "rank", F.round("score", 6).alias("score"))


CONFIGS = {
    "route_topk_docs": BASE,
    "route_head_max": replace(BASE, head="max"),
    "route_query_mean": replace(BASE, query="mean"),
    "route_query_last": replace(BASE, query="last"),
    "route_chunk_mean": replace(BASE, chunk="mean"),
    "route_all_means": replace(BASE, query="mean", chunk="mean"),
    "route_cosine": replace(BASE, score="cosine"),
    "route_scaled_dot": replace(BASE, score="scaled", head="max", query="last"),
}


def ordered_scores_sql(c: MemoryConfig) -> str:
    """toks with every addition in its place, so that equal vectors tie and ties go to the smaller id, whatever threads read the rows."""
    added = lambda a, b, h: " + ".join(f"{a}[{d}] * {b}[{d}]" for d in range(8 * h + 1, 8 * h + 9))
    lengths = f"[{', '.join(added('e', 'e', h) for h in range(8))}] AS n"
    score = lambda h: f"({added('q.e', 'm.e', h)})" if c.score == "dot" else f"coalesce(({added('q.e', 'm.e', h)}) / nullif(sqrt(q.n[{h + 1}] * m.n[{h + 1}]), 0), 0)"
    return f"""
        WITH q AS (SELECT *, {lengths} FROM (SELECT (vec_id // 100) // 3 AS query_id, (vec_id // 100) % 3 AS tok, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 100 = 0)),
        m AS (SELECT *, {lengths} FROM (SELECT vec_id // 8 AS doc_id, vec_id AS chunk_id, embedding::DOUBLE[] AS e FROM embeddings)),
        toks AS (SELECT query_id, tok, doc_id, chunk_id, ({" + ".join(map(score, range(8)))}) / 8 AS s FROM q, m),"""


def scores_sql(c: MemoryConfig, ordered: bool = False) -> str:
    cut = lambda t: f"{t}.e[8 * i + 1:8 * i + 8]"
    score = f"list_dot_product({cut('q')}, {cut('m')})"
    if c.score == "cosine":
        score += f" / (sqrt(list_dot_product({cut('q')}, {cut('q')})) * sqrt(list_dot_product({cut('m')}, {cut('m')})))"
    if c.score == "scaled":
        score += " / sqrt(8.0::DOUBLE)"
    name = {"max": "max", "mean": "avg"}
    query = "arg_max(s, tok)" if c.query == "last" else f"{name[c.query]}(s)"
    toks = f"""
        WITH q AS (SELECT (vec_id // 100) // 3 AS query_id, (vec_id // 100) % 3 AS tok, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 100 = 0),
        m AS (SELECT vec_id // 8 AS doc_id, vec_id AS chunk_id, embedding::DOUBLE[] AS e FROM embeddings),
        heads AS (SELECT query_id, tok, doc_id, chunk_id, {score} AS s FROM q, m, range(8) r(i)),
        toks AS (SELECT query_id, tok, doc_id, chunk_id, {name[c.head]}(s) AS s FROM heads GROUP BY ALL),"""
    return f"""{ordered_scores_sql(c) if ordered else toks}
        chunked AS (SELECT query_id, doc_id, chunk_id, {query} AS s FROM toks GROUP BY query_id, doc_id, chunk_id),
        scored AS (SELECT query_id, doc_id, {name[c.chunk]}(s) AS score FROM chunked GROUP BY query_id, doc_id),
        ranked AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank, score FROM scored)
    """


def top_sql(c: MemoryConfig, where: str = "", ordered: bool = False) -> str:
    return scores_sql(c, ordered) + f"SELECT query_id, doc_id, rank, round(score, 6) AS score FROM ranked WHERE rank <= {c.top_k} {where}"


def route_query(config: MemoryConfig):
    return lambda spark, sf_dir: rounded(routing.route(chunks(spark, sf_dir), tokens(spark, sf_dir), config))


def route_sharded_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(routing.route_sharded(chunks(spark, sf_dir), tokens(spark, sf_dir), BASE, 7))


def route_variable_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = tokens(spark, sf_dir)
    wanted = asked.groupBy("query_id").agg((F.count("*") * 2 + F.col("query_id") % 3).alias("k"))
    return rounded(routing.route_variable(chunks(spark, sf_dir), asked, BASE, wanted))


def winner_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks of each query's best documents, in the order of shard, document and chunk."""
    memory = chunks(spark, sf_dir)
    won = routing.route(memory, tokens(spark, sf_dir), BASE)
    found = won.select("query_id", "doc_id").join(memory.select("doc_id", "chunk_id"), "doc_id")
    listed = F.array_sort(F.collect_list(F.struct(F.pmod("doc_id", F.lit(4)).alias("shard"), "doc_id", "chunk_id")))
    text = F.array_join(F.transform(listed, lambda x: x["chunk_id"].cast("string")), ",")
    return found.groupBy("query_id").agg(F.count("*").alias("n_chunks"), text.alias("chunk_ids"))


def selected_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks that some query selects (semi join), each once."""
    memory = chunks(spark, sf_dir)
    won = routing.route(memory, tokens(spark, sf_dir), BASE).select("doc_id").distinct()
    return memory.select("doc_id", "chunk_id").join(won, "doc_id", "left_semi")


def attention_readout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all question tokens read from a template (the first four vectors), the best documents' chunks and the question so far."""
    memory, asked = chunks(spark, sf_dir), tokens(spark, sf_dir)
    won = routing.route(memory, asked, BASE).select("query_id", "doc_id")
    template = [(r["vec"], r["vec"]) for r in memory.where("chunk_id < 4").orderBy("chunk_id").collect()]
    said = asked.select("query_id", "tok", *[F.col("vec").alias(c) for c in "qkv"])
    out = readout.read_out(memory.select("doc_id", F.col("vec").alias("k"), F.col("vec").alias("v")), won, said, template, 8, 8, 8**-0.5)
    rows = out.select("query_id", "tok", F.posexplode("vec").alias("dim", "value"))
    return rows.select("query_id", "tok", F.col("dim").cast("long").alias("dim"), F.round("value", 6).alias("value"))


def late_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes on a snapshot's router keys, then reads keys and values of the best documents from the files that hold them."""
    path = scratch(spark, "memory")
    rows = chunks(spark, sf_dir).select("doc_id", "chunk_id", F.col("vec").alias("rk"), F.transform("vec", lambda x: x * 2).alias("k"), F.reverse("vec").alias("v"))
    snapshots.place_memory(rows, path, 64)
    won = routing.route(snapshots.read_placed(spark, path, "rk").withColumnRenamed("rk", "vec"), tokens(spark, sf_dir), replace(BASE, top_k=2))
    found = snapshots.fetch_placed(spark, path, won, "k", "v").join(won.select("query_id", "doc_id"), "doc_id")
    total = F.aggregate("k", F.lit(0.0), lambda t, x: t + x)
    return found.select("query_id", "doc_id", "chunk_id", F.round(total, 6).alias("k_sum"), F.round(F.get("v", F.lit(0)), 6).alias("v_first"))


def batch_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of 21 vectors, the first few of which ask the others, padded to one length: tokens on the left, chunks on the right."""
    rows = chunks(spark, sf_dir).select(F.floor(F.col("chunk_id") / 21).cast("long").alias("sample"), (F.col("chunk_id") % 21).alias("at"), "vec")
    asks = F.col("at") < 3 + F.col("sample") % 3
    side = lambda keep: F.transform(F.array_sort(F.collect_list(F.when(keep, F.struct("at", "vec")))), lambda x: x["vec"])
    held = rows.groupBy("sample").agg(side(asks).alias("q0"), side(~asks).alias("k0"))
    pads = lambda n, value: F.array_repeat(F.array_repeat(F.lit(value), 64), n)
    ones = lambda c: F.transform(c, lambda _: F.lit(1))
    none = lambda n: F.array_repeat(F.lit(0), n)
    left, right = 6 - F.size("q0"), 18 - F.size("k0")
    padded = held.select("sample", F.concat(pads(left, 7.0), "q0").alias("q"), F.concat(none(left), ones("q0")).alias("q_mask"), F.concat("k0", pads(right, -9.0)).alias("k"), F.concat(ones("k0"), none(right)).alias("k_mask"))
    return routing.masked_scores(padded, replace(BASE, query="mean")).select("sample", "chunk", F.round("score", 6).alias("score"))


def pool_mean_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of documents of 21, pooled four by four; the last chunk of a document is shorter."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    placed = rows.select(F.floor(F.col("vec_id") / 21).cast("long").alias("doc_id"), (F.col("vec_id") % 21).alias("pos"), vectors.doubles(F.col("embedding")).alias("vec"))
    out = routing.pooled_chunks(placed, 4)
    return out.select("doc_id", "chunk", F.col("dim").cast("long").alias("dim"), F.round("value", 6).alias("value"))


def pool_qkv_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries, keys and values of documents of 21, pooled four by four."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vec = vectors.doubles(F.col("embedding"))
    placed = rows.select(F.floor(F.col("vec_id") / 21).cast("long").alias("doc_id"), (F.col("vec_id") % 21).alias("pos"), vec.alias("q"), F.transform(vec, lambda x: x * 2).alias("k"), F.reverse(vec).alias("v"))
    out = routing.pooled_chunks(placed, 4, ("q", "k", "v"))
    return out.select("doc_id", "chunk", F.col("dim").cast("long").alias("dim"), *[F.round(c, 6).alias(c) for c in "qkv"])


def recall_fanin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two queries make a request; what each found in two layers, in their order."""
    memory, asked = chunks(spark, sf_dir), tokens(spark, sf_dir)
    found = None
    for layer, config in ((18, replace(BASE, top_k=3)), (19, replace(BASE, top_k=3, score="cosine"))):
        ids = F.transform(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))), lambda x: x["doc_id"])
        rows = routing.route(memory, asked, config).groupBy("query_id").agg(ids.alias("ids"))
        rows = rows.select(F.floor(F.col("query_id") / 2).cast("long").alias("request"), F.lit(layer).cast("long").alias("layer"), (F.col("query_id") % 2).alias("seq"), "ids")
        found = rows if found is None else found.unionByName(rows)
    said = F.array_join(F.transform("lists", lambda x: F.array_join(F.transform(x, lambda i: i.cast("string")), ",")), ";")
    return corpora.recall_lists(found).select("request", "layer", said.alias("lists"))


def pool_fixed_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of four vectors, whatever document they are of."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    placed = rows.select(F.lit(0).cast("long").alias("doc_id"), F.col("vec_id").alias("pos"), vectors.doubles(F.col("embedding")).alias("vec"))
    out = routing.pooled_chunks(placed, 4)
    return out.select("chunk", F.col("dim").cast("long").alias("dim"), F.round("value", 6).alias("value"))


def normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    v = vectors.unit(F.transform(vectors.doubles(F.col("embedding")), lambda x: x * 3))
    return rows.select("vec_id", F.round(v[0], 6).alias("first"), F.round(v[63], 6).alias("last"), F.round(vectors.norm(v), 6).alias("norm"))


def grouped_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector against the one after it, eight query heads over two key heads."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", vectors.doubles(F.col("embedding")).alias("vec"))
    q = rows.select("vec_id", F.col("vec").alias("q"))
    k = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("vec").alias("k"))
    return routing.grouped_scores(q.join(k, "vec_id"), "q", "k", 8, 2, 8).select("vec_id", "head", F.round("score", 6).alias("score"))


def weights(n: int) -> np.ndarray:
    """A fixed linear map from 64 values to n."""
    i, j = np.ogrid[:n, :64]
    return ((i * 7 + j * 3) % 5 - 2) / 4.0


def router_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as hidden states, projected for sixteen values of queries and four of keys."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", vectors.doubles(F.col("embedding")).alias("vec"))
    both = rows.select("vec_id", *[hooks.projection(weights(n))(F.col("vec")).alias(c) for c, n in (("q", 16), ("k", 4))])
    parts = [both.select("vec_id", F.lit(c).alias("kind"), F.posexplode(c).alias("dim", "value")) for c in ("q", "k")]
    return parts[0].unionByName(parts[1]).select("vec_id", "kind", F.col("dim").cast("long").alias("dim"), F.round("value", 6).alias("value"))


WON = top_sql(BASE)
QUERIES = {name: route_query(c) for name, c in CONFIGS.items()} | {
    "route_sharded_topk": route_sharded_topk,
    "route_variable_k": route_variable_k,
    "winner_chunks": winner_chunks,
    "semi_selected_chunks": selected_chunks,
    "attention_readout": attention_readout,
    "late_fetch": late_fetch,
    "batch_scores": batch_scores,
    "pool_qkv_chunks": pool_qkv_chunks,
    "recall_fanin": recall_fanin,
    "pool_mean_chunks": pool_mean_chunks,
    "pool_fixed_window": pool_fixed_window,
    "l2_normalise": normalised,
    "grouped_heads": grouped_heads,
    "router_projections": router_projections,
}
POOL = """
    SELECT {key}, d - 1 AS dim, round(avg(e[d]), 6) AS value
    FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), range(1, 65) r(d) GROUP BY ALL
"""
ORACLE_SQL = {name: top_sql(c, ordered=c.score == "cosine") for name, c in CONFIGS.items()} | {
    "route_sharded_topk": WON,
    "router_projections": """
        SELECT vec_id, kind, i AS dim, round(list_dot_product(embedding::DOUBLE[], list_transform(range(64), lambda j: (((i * 7 + j * 3) % 5) - 2) / 4.0::DOUBLE)), 6) AS value
        FROM embeddings, (SELECT 'q' AS kind, unnest(range(16)) AS i UNION ALL SELECT 'k', unnest(range(4)))""",
    "route_variable_k": scores_sql(BASE)
    + """, k AS (SELECT query_id, count(*) * 2 + query_id % 3 AS k FROM q GROUP BY query_id)
        SELECT query_id, doc_id, rank, round(score, 6) AS score FROM ranked JOIN k USING (query_id) WHERE rank <= least(k, 16)""",
    "winner_chunks": scores_sql(BASE)
    + """SELECT query_id, count(*)::BIGINT AS n_chunks, string_agg(m.chunk_id::VARCHAR, ',' ORDER BY doc_id % 4, doc_id, m.chunk_id) AS chunk_ids
        FROM ranked JOIN m USING (doc_id) WHERE rank <= 16 GROUP BY query_id""",
    "semi_selected_chunks": scores_sql(BASE) + "SELECT doc_id, chunk_id FROM m WHERE doc_id IN (SELECT doc_id FROM ranked WHERE rank <= 16)",
    "attention_readout": scores_sql(BASE)
    + """, seen AS (
            SELECT q.query_id, q.tok, q.e AS a, m.e FROM q JOIN m ON m.chunk_id < 4
            UNION ALL SELECT q.query_id, q.tok, q.e, m.e FROM q JOIN ranked ON ranked.query_id = q.query_id AND rank <= 16 JOIN m ON m.doc_id = ranked.doc_id
            UNION ALL SELECT q.query_id, q.tok, q.e, o.e FROM q JOIN q o ON o.query_id = q.query_id AND o.tok <= q.tok),
        near AS (SELECT query_id, tok, h, e, exp(list_dot_product(a[8 * h + 1:8 * h + 8], e[8 * h + 1:8 * h + 8]) / sqrt(8.0::DOUBLE)) AS w FROM seen, range(8) r(h))
        SELECT query_id, tok, d - 1 AS dim, round(sum(w * e[d]) / sum(w), 6) AS value FROM near, range(1, 65) g(d) WHERE (d - 1) // 8 = h GROUP BY query_id, tok, d""",
    "late_fetch": scores_sql(BASE)
    + """SELECT query_id, doc_id, chunk_id, round(2 * list_sum(e), 6) AS k_sum, round(e[64], 6) AS v_first FROM ranked JOIN m USING (doc_id) WHERE rank <= 2""",
    "batch_scores": """
        WITH v AS (SELECT vec_id // 21 AS sample, vec_id % 21 AS place, embedding::DOUBLE[] AS e FROM embeddings),
        q AS (SELECT * FROM v WHERE place < 3 + sample % 3), k AS (SELECT *, place - 3 - sample % 3 AS chunk FROM v WHERE place >= 3 + sample % 3)
        SELECT sample, chunk, round(avg(list_dot_product(q.e, k.e) / 8), 6) AS score FROM q JOIN k USING (sample) GROUP BY ALL""",
    "pool_qkv_chunks": """
        SELECT vec_id // 21 AS doc_id, (vec_id % 21) // 4 AS chunk, d - 1 AS dim, round(avg(e[d]), 6) AS q, round(avg(2 * e[d]), 6) AS k, round(avg(e[65 - d]), 6) AS v
        FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), range(1, 65) r(d) GROUP BY ALL""",
    "recall_fanin": "SELECT request, layer, string_agg(ids, ';' ORDER BY seq) AS lists FROM ("
    + " UNION ALL ".join(f"SELECT query_id // 2 AS request, {layer}::BIGINT AS layer, query_id % 2 AS seq, string_agg(doc_id, ',' ORDER BY rank) AS ids FROM ({top_sql(replace(BASE, top_k=3, score=how), ordered=True)}) GROUP BY query_id" for layer, how in ((18, "dot"), (19, "cosine")))
    + ") GROUP BY request, layer",
    "pool_mean_chunks": POOL.format(key="vec_id // 21 AS doc_id, (vec_id % 21) // 4 AS chunk"),
    "pool_fixed_window": POOL.format(key="vec_id // 4 AS chunk"),
    "grouped_heads": """
        SELECT q.vec_id, h AS head, round(list_dot_product((q.embedding::DOUBLE[])[8 * h + 1:8 * h + 8], (k.embedding::DOUBLE[])[8 * (h // 4) + 1:8 * (h // 4) + 8]), 6) AS score
        FROM embeddings q JOIN embeddings k ON k.vec_id = q.vec_id + 1, range(8) r(h)""",
    "l2_normalise": """
        WITH u AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS e FROM embeddings)
        SELECT vec_id, round(e[1], 6) AS first, round(e[64], 6) AS last, round(sqrt(list_dot_product(e, e)), 6) AS norm FROM u""",
}
