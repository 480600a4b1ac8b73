"""Approximate nearest neighbours by cosine: inverted lists with an adaptive dimension scan.

Vectors are made unit length and rotated by one random orthogonal matrix, so
that any block of columns is a random projection.  Within each list that a query
probes, squared distances grow block by block of columns; after each block a
candidate is abandoned if its partial distance, scaled to all dimensions,
exceeds the best distances so far by more than the test allows for the
dimensions seen.  The cosines of the nearest survivors are computed on the
original vectors in double precision.

Centroids come from a bounded sample of vectors; every vector is in a list.
The number of probed lists is the smallest with which the sample's own queries
find the wanted share of their true neighbours in the sample (whose neighbours
are farther apart, so this errs to more lists); a query also probes on until
its lists hold enough vectors.  Equal vectors are one candidate with their
smallest ids, so copies cost nothing and ties are exact.

The table of lists is sorted by list once.  Queries are taken in blocks of
bounded size, with the lists that each probes as bits; a block goes to the tasks
that read the lists, and these hand on each query's best in what they have
read.  So neither vectors nor queries are shuffled by what probes what, and a
list or a query that is in great demand has no task of its own.

Defined cases: vectors that are null, zero, hold null or non-finite components
or differ in length from most vectors take no part, neither do null ids; rows
with one id and one vector count once; an empty table gives no rows; a query
with fewer than k candidates gets them all; the length of vectors bounds only
how many are in memory at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from memloom.llm.common import scratch, written


@dataclass(frozen=True)
class Options:
    """sample bounds the vectors that centroids are fitted on; epsilon is the test's tolerance; query_bytes bounds a block of queries."""

    k: int = 5
    sample: int = 20_000
    lists: int = 2048
    recall: float = 0.97
    query_bytes: int = 8 << 20
    block: int = 16
    epsilon: float = 2.1
    seed: int = 5


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, v): v holds the components as little-endian doubles, of the most common length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if vec_id is not None and v and None not in v:
                    x = np.array(v, dtype="<f8")
                    if np.isfinite(x).all() and x.any():
                        ids.append(vec_id)
                        out.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["vec_id", "v"])

    found = written(rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(run, "vec_id long, v binary"), "vectors")
    most = found.groupBy(F.octet_length("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return found.where(F.octet_length("v") == (most["size"] if most else 0))


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(v, ids): each different vector with its smallest ids; batches hand on one row for each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own: dict[bytes, set] = {}
            for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own.setdefault(v, set()).add(vec_id)
            ids = [sorted(s)[:keep] for s in own.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.binary()), pa.array(ids, pa.list_(pa.int64()))], names=["v", "ids"])

    parts = rows.select("vec_id", "v").mapInArrow(run, "v binary, ids array<long>")
    return parts.groupBy("v").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids"))


@dataclass
class Index:
    """What tasks need: rotation, centroids, lists to probe, sizes of lists."""

    rotation: np.ndarray
    centroids: np.ndarray
    probes: int
    sizes: np.ndarray


def centroids_of(x: np.ndarray, n: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """Spherical k-means."""
    c = x[np.random.default_rng(seed).choice(len(x), n, replace=False)]
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 0, sums / np.maximum(size, 1e-12), c)
    return c


def fit(vectors: DataFrame, total: int, o: Options) -> Index:
    sample = vectors.orderBy(F.xxhash64("v"), "v").limit(o.sample).select("v").toArrow()
    x = unit(np.frombuffer(b"".join(sample["v"].to_pylist()), dtype="<f8").reshape(sample.num_rows, -1))
    dim = x.shape[1]
    rng = np.random.default_rng(o.seed)
    rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    n = int(min(o.lists, max(1, round(total**0.5)), len(x)))
    c = centroids_of(x, n, seed=o.seed)
    asked = x[rng.choice(len(x), min(len(x), 300), replace=False)]
    near = np.argsort(-(asked @ x.T), axis=1)[:, 1 : o.k + 1]
    own = (x @ c.T).argmax(1)
    place = np.argsort(np.argsort(-(asked @ c.T), axis=1), axis=1)
    ranks = np.take_along_axis(place, own[near], axis=1).ravel()
    probes = int(np.quantile(ranks, o.recall)) + 1 if len(ranks) else n
    return Index(rotation, c, probes, np.zeros(n, np.int64))


def stacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(len(column), -1)


def scan(x: np.ndarray, q: np.ndarray, k: int, block: int, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of q, row of x) that hold each q's k nearest rows of x, and others as near; all rotated and of unit length.

    While most candidates are left, a block of columns is done for all at once;
    after that for those left alone.
    """
    (m, dim), n = q.shape, len(x)
    if n <= k:
        return np.repeat(np.arange(m), n), np.tile(np.arange(n), m)
    first = min(n, max(64, 4 * k, n // 8))
    limit = np.partition(2 - 2 * (q @ x[:first].T), k - 1, axis=1)[:, k - 1]
    alive, partial, at = np.ones((m, n), dtype=bool), np.zeros((m, n)), 0

    def most(seen: int) -> np.ndarray:
        slack = (1 + epsilon / seen**0.5) ** 2 if seen < dim else 1 + 1e-6
        return (limit * slack + 1e-9) * (seen / dim)

    while at < dim and (not at or alive.sum() > 0.1 * m * n):
        own, asked = x[:, at : at + block], q[:, at : at + block]
        partial += (own**2).sum(1)[None] + (asked**2).sum(1)[:, None] - 2 * (asked @ own.T)
        at = min(at + block, dim)
        alive &= partial <= most(at)[:, None]
    i, j = np.nonzero(alive)
    near = partial[i, j]
    while at < dim:
        near = near + ((x[j, at : at + block] - q[i, at : at + block]) ** 2).sum(1)
        at = min(at + block, dim)
        left = near <= most(at)[i]
        i, j, near = i[left], j[left], near[left]
    order = np.lexsort((near, i))
    i, j, near = i[order], j[order], near[order]
    starts = np.searchsorted(i, np.arange(m))
    last = np.minimum(starts + k, np.r_[starts[1:], len(i)]) - 1
    left = near <= near[last[i]] + 1e-9
    return i[left], j[left]


@dataclass
class Asked:
    """A block of queries: original vectors, keys, and for each list the queries that probe it."""

    q: np.ndarray
    keys: list[tuple[int, int]]
    probed: np.ndarray


def nearest(rows: DataFrame, is_query, options: Options = Options()) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that is_query picks, its k nearest other rows that were found."""
    o, spark = options, rows.sparkSession
    keep = o.k + 1
    vectors = usable(rows)
    candidates = written(distinct_vectors(vectors, keep), "distinct")
    total = candidates.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = fit(candidates, total, o)
    sent = spark.sparkContext.broadcast(index)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = (unit(stacked(batch.column(0))) @ sent.value.centroids.T).argmax(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int64))], names=["v", "ids", "list"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lists = candidates.mapInArrow(assign, "v binary, ids array<long>, list long")
    lists = written(lists.repartitionByRange(parts, "list", F.xxhash64("v")).sortWithinPartitions("list"), "lists")
    for row in lists.groupBy("list").count().collect():
        index.sizes[row["list"]] = row["count"]
    probing = spark.sparkContext.broadcast(index)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = probing.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                own = batch.slice(at, 512)
                order = np.argsort(-(unit(stacked(own.column(0))) @ ix.centroids.T), axis=1, kind="stable")
                held = np.cumsum(ix.sizes[order], axis=1)
                n = np.maximum(ix.probes, (held < 10 * keep).sum(1) + 1)
                probed = np.zeros(order.shape, dtype=bool)
                np.put_along_axis(probed, order, np.arange(order.shape[1]) < n[:, None], axis=1)
                bits = [b.tobytes() for b in np.packbits(probed, axis=1)]
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(bits, pa.binary())], names=["q", "k1", "k2", "probed"])

    queries = vectors.where(is_query(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")).distinct()
    queries = written(queries.withColumns({"k1": F.xxhash64("q"), "k2": F.xxhash64(F.lit(1), "q")}), "queries")
    asked = queries.select("q", "k1", "k2").distinct().mapInArrow(probe, "q binary, k1 long, k2 long, probed binary")
    asked = written(asked, "asked")
    size = asked.agg(F.sum(F.octet_length("q") + F.octet_length("probed") + 16)).first()[0] or 0
    blocks, folder = max(1, -(-size // o.query_bytes)), scratch(spark, "hits")
    for b in range(blocks):
        table = asked.where(F.pmod("k2", F.lit(blocks)) == b).toArrow()
        if table.num_rows:
            probed = np.unpackbits(np.array([np.frombuffer(x, np.uint8) for x in table["probed"].to_pylist()]), axis=1).astype(bool)
            keys = list(zip(table["k1"].to_pylist(), table["k2"].to_pylist()))
            block = spark.sparkContext.broadcast(Asked(stacked(table["q"].combine_chunks()), keys, probed))
            _best(lists, sent, block, keep, o).write.mode("append").parquet(folder)
            block.unpersist()
    hits = spark.read.schema("k1 long, k2 long, vec_id long, score double").parquet(folder) if size else spark.createDataFrame([], "k1 long, k2 long, vec_id long, score double")
    best = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), "vec_id")
    top = hits.withColumn("n", F.row_number().over(best)).where(F.col("n") <= keep).drop("n")
    mine = queries.drop("q").join(top, ["k1", "k2"]).where(F.col("vec_id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return mine.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= o.k).select("query_id", "rank", "vec_id", "score")


def _best(lists: DataFrame, sent, block, keep: int, o: Options, queries: int = 256) -> DataFrame:
    """k1, k2, vec_id, score: the best of each run of one list in a batch, for the block's queries that probe it."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotation, own = sent.value.rotation, block.value
        size, rq = np.linalg.norm(own.q, axis=1), unit(own.q) @ rotation
        for batch in batches:
            number = batch.column(2).to_numpy()
            ends = np.flatnonzero(np.r_[number[1:] != number[:-1], True]) + 1 if len(number) else []
            at = 0
            for end in ends:
                for a in range(at, end, 4096):
                    some = batch.slice(a, min(4096, end - a))
                    asking = np.flatnonzero(own.probed[:, number[at]])
                    x, ids = stacked(some.column(0)), some.column(1).to_pylist()
                    norm, rx = np.linalg.norm(x, axis=1), unit(x) @ rotation
                    for c in range(0, len(asking), queries):
                        rows = asking[c : c + queries]
                        i, j = scan(rx, rq[rows], keep, o.block, o.epsilon)
                        score = (x[j] * own.q[rows[i]]).sum(1) / (norm[j] * size[rows[i]])
                        yield _ranked(rows[i], j, score, ids, own.keys, keep)
                at = end

    return lists.mapInArrow(search, "k1 long, k2 long, vec_id long, score double")


def _ranked(row: np.ndarray, j: np.ndarray, score: np.ndarray, ids: list, keys: list[tuple[int, int]], keep: int) -> pa.RecordBatch:
    """The ids of each row's best candidates, ties to the smaller id."""
    out: tuple[list, list, list, list] = ([], [], [], [])
    found: dict[int, list[tuple[float, int]]] = {}
    for r, s, c in zip(row.tolist(), score.tolist(), j.tolist()):
        found.setdefault(r, []).extend((-s, i) for i in ids[c])
    for r, own in found.items():
        own.sort()
        for s, i in own[:keep]:
            for column, value in zip(out, (*keys[r], i, -s)):
                column.append(value)
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.float64())], names=["k1", "k2", "vec_id", "score"])


def neighbour_report(rows: DataFrame) -> DataFrame:
    return nearest(rows, lambda vec_id: vec_id % 50 == 0)
