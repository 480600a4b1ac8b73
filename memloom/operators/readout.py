"""Attention read-out over template, chosen chunks and question, by partial softmax states that merge.

Each place where keys lie works out, for the query tokens that see them, the
largest score, the sum of the weights and the weighted sum of values, a head
each.  Such states merge in any order into the softmax over all keys, so keys and
values stay where they are: chunks are met by broadcast blocks of query tokens,
the template is broadcast, and a question's own tokens, which see each other
only backwards, are one small group.  What is shuffled is a row for each query
token and batch of keys that it sees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memloom.operators.routing import query_blocks, vectors_of

STATE = "query_id long, tok long, top array<double>, weight array<double>, acc array<double>"


def states(q: np.ndarray, k: np.ndarray, v: np.ndarray, heads: int, kv_heads: int, scale: float, seen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """top and weight (token, head) and acc (token, head, width of a value) over the keys that a token sees; all if not said."""
    group = heads // kv_heads
    q = q.reshape(len(q), heads, -1)
    k, v = (np.repeat(x.reshape(len(x), kv_heads, -1), group, axis=1) for x in (k, v))
    scores = np.einsum("thd,khd->thk", q, k) * scale
    if seen is not None:
        scores = np.where(seen[:, None, :], scores, -np.inf)
    top = scores.max(axis=2)
    w = np.exp(scores - top[:, :, None])
    return top, w.sum(axis=2), np.einsum("thk,khd->thd", w, v)


def merged(top: np.ndarray, weight: np.ndarray, acc: np.ndarray) -> np.ndarray:
    """The softmax mean (head, width) from states stacked along the first axis."""
    share = np.exp(top - top.max(axis=0))
    return (share[:, :, None] * acc).sum(axis=0) / (share * weight).sum(axis=0)[:, None]


def _batch(ids: list, toks: list, found: list) -> pa.RecordBatch:
    top, weight, acc = (np.concatenate([f[k].reshape(len(f[k]), -1) for f in found]) for k in range(3))
    lists = [pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel())) for x in (top, weight, acc)]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(toks)), *lists], names=["query_id", "tok", "top", "weight", "acc"])


def chunk_states(memory: DataFrame, won: DataFrame, tokens: DataFrame, heads: int, kv_heads: int, scale: float, most: int = 4096) -> DataFrame:
    """States over the chunks of each query's documents.  memory: doc_id, k, v; won: query_id, doc_id; tokens: query_id, tok, q."""
    spark = memory.sparkSession
    out = spark.createDataFrame([], STATE)
    for block in query_blocks(tokens.select("query_id", "tok", F.col("q").alias("vec")), most):
        ids, toks = (np.array([b[k] for b in block]) for k in (0, 1))
        vectors = np.array([b[2] for b in block])
        # A stated set's documents: top_k for each of its queries.
        chosen = won.join(F.broadcast(spark.createDataFrame([(int(q),) for q in np.unique(ids)], "query_id long")), "query_id")
        wanted: dict[int, list[int]] = {}
        for r in chosen.select("query_id", "doc_id").collect():
            wanted.setdefault(r["doc_id"], []).append(r["query_id"])
        sent = spark.sparkContext.broadcast((ids, toks, vectors, wanted))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, toks, vectors, wanted = sent.value
            for batch in batches:
                docs = batch.column(0).to_numpy()
                rows_of: dict[int, list[np.ndarray]] = {}
                for doc in np.unique(docs).tolist():
                    for query in wanted.get(doc, ()):
                        rows_of.setdefault(query, []).append(np.flatnonzero(docs == doc))
                if not rows_of:
                    continue
                k, v = vectors_of(batch.column(1)), vectors_of(batch.column(2))
                found = []
                for query, rows in rows_of.items():
                    rows, own = np.concatenate(rows), np.flatnonzero(ids == query)
                    found.append((ids[own], toks[own], states(vectors[own], k[rows], v[rows], heads, kv_heads, scale)))
                yield _batch([f[0] for f in found], [f[1] for f in found], [f[2] for f in found])

        out = out.unionByName(memory.select("doc_id", "k", "v").mapInArrow(run, STATE))
    return out


def question_states(tokens: DataFrame, template: list[tuple[list[float], list[float]]], heads: int, kv_heads: int, scale: float) -> DataFrame:
    """States over the template (keys and values, seen by all) and over a question's own tokens up to each.  tokens: query_id, tok, q, k, v."""
    sent = tokens.sparkSession.sparkContext.broadcast(template)

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("tok")
        q, k, v = (vectors_of(rows[c].combine_chunks()) for c in ("q", "k", "v"))
        n, head = len(q), sent.value
        if head:
            k, v = (np.concatenate([np.array([h[j] for h in head]), x]) for j, x in enumerate((k, v)))
        seen = np.arange(len(head) + n)[None, :] <= len(head) + np.arange(n)[:, None]
        return pa.Table.from_batches([_batch([rows["query_id"].to_numpy()], [rows["tok"].to_numpy()], [states(q, k, v, heads, kv_heads, scale, seen)])])

    return tokens.select("query_id", "tok", "q", "k", "v").groupBy("query_id").applyInArrow(run, STATE)


def read_out(memory: DataFrame, won: DataFrame, tokens: DataFrame, template: list, heads: int, kv_heads: int, scale: float) -> DataFrame:
    """query_id, tok, vec: what each question token reads from template, its query's documents (all their chunks) and the question up to it."""
    parts = question_states(tokens, template, heads, kv_heads, scale).unionByName(chunk_states(memory, won, tokens, heads, kv_heads, scale))

    def merge(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("tok")
        toks = rows["tok"].to_numpy()
        top, weight, acc = (vectors_of(rows[c].combine_chunks()) for c in ("top", "weight", "acc"))
        acc = acc.reshape(*top.shape, -1)
        cuts = np.flatnonzero(np.r_[True, toks[1:] != toks[:-1], True])
        vec = [merged(top[a:b], weight[a:b], acc[a:b]).ravel() for a, b in zip(cuts, cuts[1:])]
        own = pa.array(np.full(len(vec), rows["query_id"][0].as_py()))
        return pa.table({"query_id": own, "tok": pa.array(toks[cuts[:-1]]), "vec": pa.array(vec, pa.list_(pa.float64()))})

    return parts.groupBy("query_id").applyInArrow(merge, "query_id long, tok long, vec array<double>")
