"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct words, word pairs and pairs that skip one word of
the whole text, hashed.  Training takes a bounded sample of labelled rows (the
max_rows whose ids have the smallest hashes) and deals it to shards, of which
one at a time is in memory.  FTRL-proximal (learning rates for each coordinate,
L1 for sparse weights) goes through the shards in turn, each starting from the
state that the one before it left: averaged states would weaken words that few
rows hold as shards grow in number, and added ones overshoot for common words.
The weights that are not zero go to all tasks as a broadcast of at most 12
bytes for each of the 2**bits buckets.

Defined cases: null and empty texts have no features and get the intercept's
score; label rows without a label, or whose document is absent, teach nothing;
without any usable label every score is 0.5; rows with one id are scored one by
one; an empty table gives no rows; a very long text is its set of buckets, one
text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memloom.llm.common import fold, held_out, sliced, written
from memloom.llm.words import grams, word_hashes


@dataclass(frozen=True)
class Options:
    """max_rows bounds the labelled rows that are fitted, shard_rows about those of a shard; alpha, beta, l1, l2 are FTRL's."""

    bits: int = 20
    max_rows: int = 16_000
    shard_rows: int = 8_000
    rounds: int = 2
    epochs: int = 3
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.0


def features(text: str | None, bits: int) -> np.ndarray:
    """Sorted distinct buckets; bucket 0 is the intercept."""
    words = word_hashes(bare=True).of(text)
    found = np.concatenate([grams(words, 1), grams(words, 2), grams(words, 2, 1)])
    return np.unique(np.r_[np.int64(0), (found >> np.uint64(64 - bits)).astype(np.int64)])


def weights_of(z: np.ndarray, n: np.ndarray, at: np.ndarray, o: Options) -> np.ndarray:
    """FTRL's closed form; the intercept has no L1."""
    l1 = np.where(at == 0, 0.0, o.l1)
    shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0.0)
    return -shrunk / ((o.beta + np.sqrt(n)) / o.alpha + o.l2)


def ftrl(rows: list[np.ndarray], labels: np.ndarray, z: np.ndarray, n: np.ndarray, o: Options) -> None:
    """Updates the state in place, one row after the other."""
    for _ in range(o.epochs):
        for at, y in zip(rows, labels):
            w = weights_of(z[at], n[at], at, o)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / o.alpha
            z[at] += g - sigma * w
            n[at] += g * g


def shards_in_turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """A table for each shard, from batches in the order of their first column, the shard."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        shard = batch.column(0).to_numpy()
        ends = np.flatnonzero(np.r_[shard[1:] != shard[:-1], True]) + 1 if len(shard) else shard
        at = 0
        for end in ends.tolist():
            if held and held[-1].column(0)[0].as_py() != shard[at]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(at, end - at))
            at = end
    if held:
        yield pa.Table.from_batches(held)


def fit(docs: DataFrame, labels: DataFrame, label: str, options: Options = Options()) -> dict[str, np.ndarray]:
    """Buckets and weights, from labelled rows outside the held-out fold."""
    o, spark = options, docs.sparkSession
    usable = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & (fold(F.col("id")) != 1))
    # An id that is labelled more than once counts once, as 1 if any label says so.
    chosen = usable.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(o.max_rows)
    shards = max(1, -(-chosen.count() // o.shard_rows))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [features(t, o.bits).astype(np.int32) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["shard", "y", "at"])

    texts = docs.select(F.col("doc_id").cast("long").alias("own_id"), F.col("text").cast("string").alias("text"))
    # One text for each id, so that the bound on labels is one on rows.
    one = texts.join(F.broadcast(chosen), F.col("own_id") == F.col("id")).groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    joined = one.select(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(shards)).alias("shard"), "y", "text")
    sample = written(joined.mapInArrow(featured, "shard long, y int, at array<int>"), "toxic")
    state = {"at": np.zeros(0, np.int64), "z": np.zeros(0), "n": np.zeros(0)}
    for _ in range(o.rounds):
        known = spark.sparkContext.broadcast(state)

        def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            z, n, own = np.zeros(1 << o.bits), np.zeros(1 << o.bits), known.value
            z[own["at"]], n[own["at"]] = own["z"], own["n"]
            for rows in shards_in_turn(batches):
                column = rows["at"].combine_chunks()
                flat, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
                lists = [flat[a:b] for a, b in zip(ends - ends[0], ends[1:] - ends[0])]
                order = np.lexsort((rows["y"].to_numpy(), [len(x) for x in lists], [int(x.sum()) for x in lists]))
                order = np.random.default_rng(0).permutation(order)
                ftrl([lists[k] for k in order], rows["y"].to_numpy()[order], z, n, o)
            at = np.flatnonzero(n > 0)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(z[at]), pa.array(n[at])], names=["bucket", "z", "n"])

        # At most max_rows rows, read by one task, and at most 2**bits back.
        table = sample.coalesce(1).sortWithinPartitions("shard").mapInArrow(train, "bucket long, z double, n double").toArrow()
        state = {"at": table["bucket"].to_numpy(), "z": table["z"].to_numpy(), "n": table["n"].to_numpy()}
        order = np.argsort(state["at"])
        state = {k: v[order] for k, v in state.items()}
    weights = weights_of(state["z"], state["n"], state["at"], o)
    keep = weights != 0
    return {"at": state["at"][keep].astype(np.int32), "w": weights[keep]}


def score(docs: DataFrame, model: dict[str, np.ndarray], threshold: float = 0.7, options: Options = Options()) -> DataFrame:
    """doc_id, score, predicted for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    bits = options.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << bits)
        dense[sent.value["at"]] = sent.value["w"]
        for batch in sliced(batches):
            sums = np.array([dense[features(t, bits)].sum() for t in batch.column(1).to_pylist()])
            p = 1.0 / (1.0 + np.exp(-np.clip(sums, -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double, predicted int")


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = score(docs, fit(docs, labels, "toxic"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
