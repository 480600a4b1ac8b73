"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short, documents long, so whole-document MinHash would say
little.  Items are partitioned by their number of shingles, each partition's
sizes within a factor; for each partition, documents are cut into blocks of
half its largest size, and three blocks make a window.  A contained item lies
in a window of which it is a fair part, whatever the document's length; so one
equal value among HASHES minima nearly always gives it away: a contained item
has Jaccard similarity of at least about 0.33 with its window, and is missed
with probability 0.67 ** HASHES, 3 in a million.  Every candidate is verified
by exact containment of its distinct shingles in the whole document.

Items are the stated query set: they are taken in blocks of bounded size, each
broadcast and held against all documents, which are never shuffled.

Defined cases: an item with fewer words than a shingle is one shingle; items
or documents that are null or without words are in no pair; repeated rows are
paired one by one; an empty table gives no rows; a very long text is searched and
verified whole, and takes 8 * HASHES bytes a word meanwhile.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memloom.llm.common import sliced, written
from memloom.llm.line_dedup import mixed
from memloom.llm.words import grams, shingles, word_hashes

HASHES, STEP = 32, 1.5
PAIRS = "doc_id long, item_id long, n_shingles long, n_common long, containment double"


def multipliers() -> np.ndarray:
    return np.random.default_rng(HASHES).integers(1, 2**63, HASHES).astype(np.uint64) * np.uint64(2) + np.uint64(1)


class Partition:
    """Items of similar size: their minima by hash function, sorted, with a bit map before them."""

    def __init__(self, items: list[int], sets: list[np.ndarray]):
        self.block = max(1, -(-max(len(sets[i]) for i in items) // 2))
        minima = np.array([(sets[i][None] * multipliers()[:, None]).min(1) for i in items])
        order = np.argsort(minima, axis=0)
        self.values = np.take_along_axis(minima, order, axis=0).T.copy()
        self.items = np.asarray(items)[order.T]
        self.flags = np.zeros((HASHES, 1 << 16), dtype=bool)
        self.flags[np.arange(HASHES)[:, None], self.values >> np.uint64(48)] = True

    def candidates(self, hashed: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) pairs with an equal minimum in some window; hashed: functions by shingles of all documents in a row."""
        counts = -(-sizes // self.block)
        docs = np.repeat(np.arange(len(sizes)), counts)
        number = np.arange(len(docs)) - np.repeat(np.cumsum(counts) - counts, counts)
        blocks = np.minimum.reduceat(hashed, starts[docs] + number * self.block, axis=1)
        windows = blocks.copy()
        for k in (1, 2):
            windows[:, :-k] = np.minimum(windows[:, :-k], blocks[:, k:])
        f, w = np.nonzero(self.flags[np.arange(HASHES)[:, None], windows >> np.uint64(48)])
        out = set()
        for function in np.unique(f):
            own = w[f == function]
            values = windows[function, own]
            a, b = (np.searchsorted(self.values[function], values, side) for side in ("left", "right"))
            for doc, low, high in zip(docs[own].tolist(), a.tolist(), b.tolist()):
                out.update((doc, item) for item in self.items[function, low:high].tolist())
        return out


class ItemIndex:
    """A block of items, ready to be held against documents."""

    def __init__(self, ids: list, sets: list[np.ndarray], words: int, threshold: float):
        self.ids, self.sets, self.words, self.threshold = ids, sets, words, threshold
        by: dict[int, list[int]] = {}
        for k, s in enumerate(sets):
            by.setdefault(math.floor(math.log(len(s), STEP) + 1e-9), []).append(k)
        self.partitions = [Partition(items, sets) for items in by.values()]

    def pairs(self, texts: list, group: int = 1 << 16) -> Iterator[tuple[int, int, int]]:
        """(text number, item number, shingles in common) of all pairs that reach the threshold."""
        known, held, numbers, total = word_hashes(), [], [], 0
        for number, text in enumerate(texts):
            words = known.of(text)
            if len(words):
                n = min(self.words, len(words))
                held.append(mixed(grams(words, n), n))
                numbers.append(number)
                total += len(held[-1])
            if held and (total >= group or number == len(texts) - 1):
                yield from self._verified(held, numbers)
                held, numbers, total = [], [], 0

    def _verified(self, held: list[np.ndarray], numbers: list[int]) -> Iterator[tuple[int, int, int]]:
        sizes = np.array([len(x) for x in held])
        starts = np.cumsum(sizes) - sizes
        hashed = np.concatenate(held)[None] * multipliers()[:, None]
        found: set[tuple[int, int]] = set()
        for partition in self.partitions:
            found |= partition.candidates(hashed, starts, sizes)
        for doc, item in sorted(found):
            own = self.sets[item]
            common = int(np.isin(own, held[doc]).sum())
            if common >= self.threshold * len(own) - 1e-9:
                yield numbers[doc], item, common


def item_blocks(items: DataFrame, words: int, threshold: float, block_bytes: int) -> Iterator[ItemIndex]:
    """Indexes of about block_bytes each, over all items with a shingle."""

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sets = [shingles(word_hashes().of(t), words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], names=["item_id", "shingles"])

    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    sets = written(rows.mapInArrow(shingled, "item_id long, shingles binary").where(F.octet_length("shingles") > 0), "items")
    size = sets.agg(F.sum(F.octet_length("shingles") + 16 * HASHES)).first()[0] or 0
    blocks = -(-size // block_bytes)
    for b in range(blocks):
        own = sets.where(F.pmod(F.xxhash64("item_id", "shingles"), F.lit(blocks)) == b).toArrow()
        if own.num_rows:
            yield ItemIndex(own["item_id"].to_pylist(), [np.frombuffer(x, dtype=np.uint64) for x in own["shingles"].to_pylist()], words, threshold)


def contaminations(docs: DataFrame, items: DataFrame, words: int = 5, threshold: float = 0.8, block_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, item_id, n_shingles (of the item), n_common, containment of every pair at or over the threshold."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = spark.createDataFrame([], PAIRS)
    for index in item_blocks(items, words, threshold, block_bytes):
        out = out.unionByName(_pairs(rows, spark.sparkContext.broadcast(index)))
    return out


def _pairs(rows: DataFrame, sent) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in sliced(batches):
            ids = batch.column(0).to_pylist()
            found = [(ids[d], index.ids[i], len(index.sets[i]), n, n / len(index.sets[i])) for d, i, n in index.pairs(batch.column(1).to_pylist())]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["doc_id", "item_id", "n_shingles", "n_common", "containment"])

    return rows.mapInArrow(run, PAIRS)


def decontaminate(docs: DataFrame, items: DataFrame, words: int = 5, threshold: float = 0.8, block_bytes: int = 16 << 20) -> DataFrame:
    """docs without the rows that hold an item."""
    at = docs.columns.index("text")
    for index in item_blocks(items, words, threshold, block_bytes):
        docs = _without(docs, docs.sparkSession.sparkContext.broadcast(index), at)
    return docs


def _without(docs: DataFrame, sent, at: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            hit = {d for d, _, _ in sent.value.pairs(batch.column(at).to_pylist())}
            yield batch.filter(pa.array([k not in hit for k in range(batch.num_rows)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
