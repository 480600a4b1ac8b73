"""Scores of query tokens against memory chunks, reduced to the best documents of each query.

Queries are a stated set, taken in blocks of bounded size; each block is
broadcast and multiplied with batches of chunks, so memory is read once for
each block and never shuffled.  With max over chunks, a batch hands on only its
own best documents of each query: a document's best chunk ranks at least as
high in its batch as over all.  A matrix product adds in an order of its own, by
which equal scores may differ in the last bit; so what comes near the best is
scored again in one stated order, and equal vectors tie.  With mean, a document's chunks are added up as they
come: one that is whole within a task (n_chunks says how many it has) competes
there, and a task hands on its best of each query and the sums of those documents
of which it has seen a part, which are few if memory is laid out by document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from memloom.config import MemoryConfig

TOKENS = "query_id long, tok long, vec array<double>"
CHUNKS = "doc_id long, chunk_id long, vec array<double>"
PARTIAL = "query_id long, doc_id long, best double, total double, n long"


#: More than rounding changes a score by, for vectors of length one.
ROUNDING = 1e-12


def _heads(v: np.ndarray, config: MemoryConfig) -> np.ndarray:
    """Vector, head, component; for cosines times a power of two, which changes none and keeps squares in range."""
    v = v.reshape(len(v), config.heads, -1)
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=2, keepdims=True))[1]) if config.score == "cosine" else v


def _scores(q: np.ndarray, x: np.ndarray, config: MemoryConfig) -> np.ndarray:
    """Token by chunk, with heads reduced, but for rounding."""
    q, x = _heads(q, config), _heads(x, config)
    if config.score == "cosine":
        q, x = (v / np.maximum(np.linalg.norm(v, axis=2, keepdims=True), 1e-300) for v in (q, x))
    out = None
    for h in range(config.heads):
        one = q[:, h] @ x[:, h].T
        out = one if out is None else np.maximum(out, one) if config.head == "max" else out + one
    scale = (1 if config.head == "max" else config.heads) * (q.shape[2] ** 0.5 if config.score == "scaled" else 1)
    return out / scale


def pair_scores(q: np.ndarray, x: np.ndarray, config: MemoryConfig) -> np.ndarray:
    """The score of each token with the chunk beside it: products are added by component and heads by number, one after the other.

    A cosine is the dot product over the root of the product of both squared
    lengths, 0 if one of them is 0: exactly 1 for a vector with itself.
    """
    added = lambda v: reduce(np.add, np.moveaxis(v, -1, 0))
    q, x = _heads(q, config), _heads(x, config)
    scores = added(q * x)
    if config.score == "cosine":
        size = np.sqrt(added(q * q) * added(x * x))
        scores = np.where(size == 0, 0.0, scores / np.where(size == 0, 1.0, size))
    if config.score == "scaled":
        scores = scores / q.shape[2] ** 0.5
    return scores.max(axis=1) if config.head == "max" else added(scores) / config.heads


def vectors_of(column: pa.Array) -> np.ndarray:
    """Lists of one length as the rows of a matrix, without an object for each number."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _by_document(docs: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct documents, the best and the sum of their chunks' scores of each query, and how many chunks there are."""
    own, inverse = np.unique(docs, return_inverse=True)
    order = np.argsort(inverse, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(inverse[order]) > 0])
    return own, np.maximum.reduceat(scores[:, order], starts, axis=1), np.add.reduceat(scores[:, order], starts, axis=1), np.bincount(inverse)


def _rows(found: list[tuple]) -> pa.RecordBatch:
    """query, doc, best, total, n arrays as one batch."""
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found])) for k in range(5)], names=["query_id", "doc_id", "best", "total", "n"])


class _Whole:
    """The best documents, of those that were seen whole, of each query of a block, and what was seen of others."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.ids, self.n = np.zeros((len(queries), 0), np.int64), np.zeros((len(queries), 0), np.int64)
        self.total = np.zeros((len(queries), 0))
        self.open: dict[int, tuple[np.ndarray, int, int]] = {}

    def add(self, docs: np.ndarray, total: np.ndarray, n: np.ndarray, wanted: np.ndarray) -> None:
        known = np.array([d in self.open for d in docs.tolist()], dtype=bool)
        whole = (n == wanted) & ~known
        late, sums = [], []
        for j in np.flatnonzero(~whole).tolist():
            doc = int(docs[j])
            t, m, _ = self.open.pop(doc, (0.0, 0, 0))
            if m + n[j] == wanted[j]:
                late.append(j)
                sums.append(t + total[:, j])
            else:
                self.open[doc] = (t + total[:, j], int(m + n[j]), int(wanted[j]))
        at = np.r_[np.flatnonzero(whole), np.array(late, dtype=np.int64)]
        ids = np.concatenate([self.ids, np.broadcast_to(docs[at], (len(self.queries), len(at)))], axis=1)
        counts = np.concatenate([self.n, np.broadcast_to(wanted[at], (len(self.queries), len(at)))], axis=1)
        totals = np.concatenate([self.total, total[:, whole], *([np.stack(sums, axis=1)] if sums else [])], axis=1)
        best = np.lexsort((ids, -(totals / np.maximum(counts, 1))), axis=1)[:, : self.k]
        self.ids, self.n, self.total = (np.take_along_axis(x, best, axis=1) for x in (ids, counts, totals))

    def parts(self) -> Iterator[tuple]:
        """Rows of documents that were not seen whole, which are forgotten."""
        for doc, (total, n, _) in self.open.items():
            size = len(self.queries)
            yield self.queries, np.full(size, doc), total, total, np.full(size, n)
        self.open.clear()

    def bests(self) -> tuple:
        return np.repeat(self.queries, self.ids.shape[1]), self.ids.ravel(), self.total.ravel(), self.total.ravel(), self.n.ravel()


def partial_scores(chunks: DataFrame, block: list[tuple[int, int, list[float]]], config: MemoryConfig) -> DataFrame:
    """Each batch's (with mean: each task's) scores of documents for one block of query tokens (query_id, tok, vec), ordered by query and token."""
    ids = np.array([b[0] for b in block])
    vectors = np.array([b[2] for b in block], dtype=np.float64)
    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    last = np.r_[first[1:], len(ids)] - 1
    sent = chunks.sparkSession.sparkContext.broadcast((ids[first], first, last, vectors))
    mean = config.chunk == "mean"

    def slices(batch: pa.RecordBatch) -> Iterator[tuple]:
        _, first, last, vectors = sent.value
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            scores = _scores(vectors, vectors_of(part.column(1)), config)
            if config.query == "last":
                scores = scores[last]
            else:
                scores = (np.maximum if config.query == "max" else np.add).reduceat(scores, first, axis=0)
                scores = scores / (last - first + 1)[:, None] if config.query == "mean" else scores
            yield part, scores, _by_document(part.column(0).to_numpy(), scores)

    def settled(x: np.ndarray, query: np.ndarray, chunk: np.ndarray) -> np.ndarray:
        """Scores of queries with the chunks beside them, rows of x, in one order of additions."""
        _, first, last, tokens = sent.value
        begin = last if config.query == "last" else first
        size = last[query] - begin[query] + 1
        ends = np.cumsum(size)
        token = np.arange(ends[-1]) - np.repeat(ends - size - begin[query], size)
        beside = np.repeat(chunk, size)
        scores = np.concatenate([pair_scores(tokens[token[at : at + 8192]], x[beside[at : at + 8192]], config) for at in range(0, len(token), 8192)])
        scores = (np.add if config.query == "mean" else np.maximum).reduceat(scores, ends - size)
        return scores / size if config.query == "mean" else scores

    def best_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, _, _, tokens = sent.value
        length = 1.0 if config.score == "cosine" else np.linalg.norm(tokens, axis=1).max()
        for batch in batches:
            found = []
            for part, scores, (docs, best, total, n) in slices(batch):
                vectors = vectors_of(part.column(1))
                within = ROUNDING * length * (1.0 if config.score == "cosine" else np.linalg.norm(vectors, axis=1).max())
                keep = np.ones(best.shape, dtype=bool)
                if len(docs) > config.top_k:
                    # Negated, so that what isn't a number is kept.
                    keep = ~(best < np.partition(best, -config.top_k, axis=1)[:, -config.top_k][:, None] - within)
                of = np.searchsorted(docs, part.column(0).to_numpy())
                query, chunk = np.nonzero(~(scores < np.where(keep, best - within, np.inf)[:, of]))
                exact = np.full(best.shape, -np.inf)
                np.maximum.at(exact, (query, of[chunk]), settled(vectors, query, chunk))
                q, d = np.nonzero(keep)
                found.append((queries[q], docs[d], exact[q, d], total[q, d], n[d]))
            if found:
                yield _rows(found)

    def whole_in_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Whole(sent.value[0], config.top_k)
        for batch in batches:
            for part, _, (docs, _, total, n) in slices(batch):
                sizes = part.column(2).to_numpy()
                held.add(docs, total, n, sizes[np.unique(part.column(0).to_numpy(), return_index=True)[1]])
                if len(held.open) > 1024:
                    yield _rows(list(held.parts()))
        yield _rows([held.bests(), *held.parts()])

    if mean:
        return chunks.select("doc_id", "vec", F.col("n_chunks").cast("long")).mapInArrow(whole_in_tasks, PARTIAL)
    return chunks.select("doc_id", "vec").mapInArrow(best_of_batches, PARTIAL)


def with_sizes(chunks: DataFrame) -> DataFrame:
    """chunks with n_chunks, their document's number of chunks, where it isn't known: counted over ids alone."""
    if "n_chunks" in chunks.columns:
        return chunks
    return chunks.join(chunks.groupBy("doc_id").agg(F.count("*").alias("n_chunks")), "doc_id")


def query_blocks(tokens: DataFrame, most: int) -> Iterator[list[tuple[int, int, list[float]]]]:
    """Query tokens in blocks of about `most`, whole queries together."""
    blocks = max(1, -(-tokens.count() // most))
    for b in range(blocks):
        own = tokens.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b).select("query_id", "tok", "vec").toArrow()
        rows = sorted(zip(*(own[c].to_pylist() for c in ("query_id", "tok", "vec"))))
        if rows:
            yield rows


def document_scores(chunks: DataFrame, tokens: DataFrame, config: MemoryConfig, most: int = 4096) -> DataFrame:
    """query_id, doc_id, score; with max over chunks only documents that can be among the best."""
    out = chunks.sparkSession.createDataFrame([], PARTIAL)
    chunks = with_sizes(chunks) if config.chunk == "mean" else chunks
    for block in query_blocks(tokens, most):
        out = out.unionByName(partial_scores(chunks, block, config))
    score = F.max("best") if config.chunk == "max" else F.sum("total") / F.sum("n")
    return out.groupBy("query_id", "doc_id").agg(score.alias("score"))


def best_documents(scores: DataFrame, k: int, by: tuple[str, ...] = ()) -> DataFrame:
    """The k best of each query (and shard, if by names one), ties to the smaller id."""
    order = Window.partitionBy("query_id", *by).orderBy(F.desc("score"), "doc_id")
    return scores.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= k)


def route(chunks: DataFrame, tokens: DataFrame, config: MemoryConfig) -> DataFrame:
    return best_documents(document_scores(chunks, tokens, config), config.top_k)


def route_sharded(chunks: DataFrame, tokens: DataFrame, config: MemoryConfig, shards: int) -> DataFrame:
    """The same by way of each shard's best; a document is in one shard."""
    scores = document_scores(chunks, tokens, config).withColumn("shard", F.pmod("doc_id", F.lit(shards)))
    return best_documents(best_documents(scores, config.top_k, ("shard",)).drop("rank", "shard"), config.top_k)


def route_variable(chunks: DataFrame, tokens: DataFrame, config: MemoryConfig, wanted: DataFrame) -> DataFrame:
    """At most wanted.k documents of each query, and no more than top_k."""
    ranked = route(chunks, tokens, config).join(wanted, "query_id")
    return ranked.where(F.col("rank") <= F.least("k", F.lit(config.top_k))).drop("k")


def grouped_scores(pairs: DataFrame, q: str, k: str, heads: int, kv_heads: int, width: int) -> DataFrame:
    """pairs with head and score, a row for each query head: heads // kv_heads query heads share a key head."""
    rows = pairs.withColumn("head", F.explode(F.sequence(F.lit(0), F.lit(heads - 1))))
    own = lambda v, h: F.slice(v, h * width + 1, width)
    at = F.floor(F.col("head") / (heads // kv_heads)).cast("int")
    score = F.aggregate(F.zip_with(own(F.col(q), F.col("head")), own(F.col(k), at), lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
    return rows.withColumn("score", score).withColumn("head", F.col("head").cast("long"))


def next_token(logits: DataFrame, by: str, token: str, logit: str) -> DataFrame:
    """The token with the largest logit, ties to the smaller token."""
    best = F.max(F.struct(F.col(logit).alias("l"), (-F.col(token)).alias("t")))
    return logits.groupBy(by).agg((-best["t"]).alias(token))


def sampled_token(logits: DataFrame, by: str, token: str, logit: str, temperature: float, seed: int) -> DataFrame:
    """A token drawn by the softmax of its logits over the temperature; the largest logit's at temperature 0.

    The largest of logit / temperature + Gumbel noise is such a draw; the noise
    comes from a digest of seed, row and token, so a task that runs again draws the same.
    """
    if not temperature:
        return next_token(logits, by, token, logit)
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), by, token))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / 2.0**52
    return next_token(logits.withColumn("_noisy", F.col(logit) / temperature - F.log(-F.log(u))), by, token, "_noisy")


def masked_scores(samples: DataFrame, config: MemoryConfig) -> DataFrame:
    """sample, chunk, score of the chunks that a mask keeps.  samples: sample, q, q_mask, k, k_mask, all padded anywhere.

    What a mask leaves out is dropped before anything is multiplied, so pads may
    hold any numbers and samples of a batch any lengths.  Without a query token
    chunks have no score.
    """

    def packed(vectors: pa.Array, mask: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The kept vectors of all samples one after the other, their places, and where each sample begins."""
        kept = mask.flatten().to_numpy(zero_copy_only=False) != 0
        flat = vectors.flatten()
        rows = vectors_of(flat)[kept] if len(flat) else np.zeros((0, 0))
        lengths = np.diff(mask.offsets.to_numpy())
        sample = np.repeat(np.arange(len(lengths)), lengths)
        place = np.arange(len(sample)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        return rows, place[kept], np.r_[0, np.cumsum(np.bincount(sample[kept], minlength=len(lengths)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, _, at = packed(batch.column(1), batch.column(2))
            k, place, begin = packed(batch.column(3), batch.column(4))
            out = np.full(len(place), np.nan)
            for s in range(batch.num_rows):
                own = slice(begin[s], begin[s + 1])
                if at[s] == at[s + 1] or begin[s] == begin[s + 1]:
                    continue
                scores = _scores(q[at[s] : at[s + 1]], k[own], config)
                out[own] = scores[-1] if config.query == "last" else scores.max(axis=0) if config.query == "max" else scores.mean(axis=0)
            names = pa.array(np.repeat(batch.column(0).to_numpy(), np.diff(begin)))
            yield pa.RecordBatch.from_arrays([names, pa.array(place.astype(np.int64)), pa.array(out, from_pandas=True)], names=["sample", "chunk", "score"])

    columns = samples.select(F.col("sample").cast("long"), "q", "q_mask", "k", "k_mask")
    return columns.mapInArrow(run, "sample long, chunk long, score double")


def pooled_chunks(vectors: DataFrame, pool: int, columns: tuple[str, ...] = ("vec",)) -> DataFrame:
    """vectors: doc_id, pos and columns.  doc_id, chunk, dim and a mean for each column (`value` for a single one): over up to `pool` tokens of one document.

    A chunk's vectors, at most `pool`, are shuffled as they are and added there.
    """
    rows = vectors.select("doc_id", F.floor(F.col("pos") / pool).cast("long").alias("chunk"), F.struct(*columns).alias("_x")).groupBy("doc_id", "chunk").agg(F.collect_list("_x").alias("_v"))
    mean = lambda c: F.transform(F.aggregate(F.slice("_v", 2, pool), F.col("_v")[0][c], lambda t, x: F.zip_with(t, x[c], lambda a, b: a + b)), lambda x: x / F.size("_v"))
    if len(columns) == 1:
        return rows.select("doc_id", "chunk", F.posexplode(mean(columns[0])).alias("dim", "value"))
    zipped = rows.select("doc_id", "chunk", F.posexplode(F.arrays_zip(*[mean(c).alias(c) for c in columns])).alias("dim", "_m"))
    return zipped.select("doc_id", "chunk", "dim", *[F.col("_m")[c].alias(c) for c in columns])
