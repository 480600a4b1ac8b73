"""Quality by importance resampling: two hashed n-gram models and Gumbel top-k.

The target model counts the words and word pairs of labelled good rows, the
raw model those of all rows, both over hashed buckets.  A row's weight is the
log of the ratio of the two models' likelihoods of its text: the sum of the
log ratios of its n-grams, times temper (1: the ratio itself; less flattens it,
so that long texts decide less).  Gumbel noise from the row's id is added, and
the rows with the largest sums are the sample: drawn without replacement, in
proportion to the weights' exponentials.

The k-th largest sum is found by counting in ever narrower intervals, so no
task sorts the table.

Defined cases: null and empty texts have weight 0; label rows without a label,
or whose document is absent, teach nothing; without a usable label all weights
are 0; rows that tie in sum and id are taken or left together, so rows with one
id and text can make the sample larger by their number; an empty table gives no
rows; a very long text is counted whole, one text at a time.
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
    """max_rows bounds the labelled rows of the target model; fraction is the sample's share of all rows."""

    bits: int = 14
    max_rows: int = 20_000
    prior: float = 1.0
    back_off: float = 1000.0
    temper: float = 1.0
    fraction: float = 0.5
    seed: int = 17


def buckets(text: str | None, bits: int) -> np.ndarray:
    words = word_hashes().of(text)
    return (np.concatenate([grams(words, 1), grams(words, 2)]) >> np.uint64(64 - bits)).astype(np.int64)


def bucket_counts(texts: DataFrame, bits: int) -> np.ndarray:
    """Counts over all texts: one row for each bucket and task, then one for each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, dtype=np.int64)
        for batch in sliced(batches):
            for text in batch.column(0).to_pylist():
                total += np.bincount(buckets(text, bits), minlength=1 << bits)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    found = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << bits)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str, options: Options = Options()) -> np.ndarray:
    """Log ratio of target and raw model by bucket."""
    o = options
    good = labels.where((F.col(label) == 1) & (fold(F.col("doc_id")) != 1)).select(F.col("doc_id").cast("long").alias("good_id")).distinct()
    chosen = good.orderBy(F.xxhash64("good_id"), "good_id").limit(o.max_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    target = bucket_counts(texts.join(F.broadcast(chosen), F.col("id") == F.col("good_id"), "left_semi"), o.bits)
    raw = bucket_counts(docs, o.bits)
    if not target.sum():
        return np.zeros(1 << o.bits)
    raw_share = (raw + o.prior) / (raw.sum() + o.prior * len(raw))
    # The target model backs off to the raw one, so that buckets that it hasn't met are bad only as far as it should have.
    return np.log((target / raw_share + o.back_off) / (target.sum() + o.back_off))


def weigh(docs: DataFrame, ratio: np.ndarray, options: Options = Options()) -> DataFrame:
    """doc_id, weight for every row."""
    sent, o = docs.sparkSession.sparkContext.broadcast(ratio), options

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = []
            for text in batch.column(1).to_pylist():
                at = buckets(text, o.bits)
                out.append(float(sent.value[at].sum()) * o.temper)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["doc_id", "weight"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, weight double")


def kth_largest(rows: DataFrame, k: int, enough: int = 10_000, cells: int = 4096) -> tuple[float, int | None]:
    """Key and id of the k-th row by key, largest first, then by smallest id; the id is None if it is null."""
    low, high = rows.agg(F.min("key"), F.max("key")).first()
    while True:
        inside = rows.where(F.col("key").between(low, high))
        width = (high - low) / cells
        if width <= 0 or low + width == low:
            break
        cell = F.least(F.floor((F.col("key") - low) / width), F.lit(cells - 1))
        counts = sorted(((r["cell"], r["n"], r["low"], r["high"]) for r in inside.groupBy(cell.alias("cell")).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect()), reverse=True)
        for _, n, low, high in counts:
            if n >= k:
                break
            k -= n
        if n <= enough:
            break
    inside = rows.where(F.col("key").between(low, high))
    if low == high:
        return low, kth_id(inside, k)
    last = inside.orderBy(F.desc("key"), F.asc_nulls_last("doc_id")).limit(k).agg(F.max(F.struct((-F.col("key")).alias("m"), F.col("doc_id").isNull().alias("none"), "doc_id")).alias("x")).first()["x"]
    return -last["m"], last["doc_id"]


def kth_id(rows: DataFrame, k: int, cells: int = 4096) -> int | None:
    """The k-th smallest id, nulls last, by counting in ever narrower intervals."""
    ids = written(rows.groupBy("doc_id").agg(F.count("*").alias("n")), "ids")
    low, high = ids.agg(F.min("doc_id"), F.max("doc_id")).first()
    if (ids.agg(F.sum(F.when(F.col("doc_id").isNotNull(), F.col("n")))).first()[0] or 0) < k:
        return None
    while low < high:
        width = (high - low) // cells + 1
        inside = ids.where(F.col("doc_id").between(low, high))
        cell = F.floor((F.col("doc_id") - low) / width)
        counts = sorted((r["cell"], r["n"], r["low"], r["high"]) for r in inside.groupBy(cell.alias("cell")).agg(F.sum("n").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).collect())
        for _, n, low, high in counts:
            if n >= k:
                break
            k -= n
    return low


def gumbel_sample(weighed: DataFrame, options: Options = Options()) -> DataFrame:
    """weighed with key and selected."""
    o = options
    u = (F.pmod(F.xxhash64("doc_id", F.lit(o.seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    rows = written(weighed.withColumn("key", F.col("weight") - F.log(-F.log(u))), "keys")
    k = int(rows.count() * o.fraction)
    if not k:
        return rows.withColumn("selected", F.lit(False))
    key, doc_id = kth_largest(rows, k)
    tie = F.lit(True) if doc_id is None else F.coalesce(F.col("doc_id") <= doc_id, F.lit(False))
    return rows.withColumn("selected", (F.col("key") > key) | ((F.col("key") == key) & tie))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, weight, key, selected for every row."""
    drawn = gumbel_sample(weigh(docs, fit(docs, labels, "quality")))
    return drawn.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "weight", "key", "selected")
