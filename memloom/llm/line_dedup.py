"""Line deduplication through a sharded minimal perfect hash.

One pass hashes every long line (128 bits of its normalised key) and counts,
for each hash, the rows that hold it and the largest doc_id among them.
Hashes that enough rows hold are split into shards; each shard becomes a
minimal perfect hash with an array of 64-bit fingerprints, one of counts and
one of largest ids.  Documents probe these arrays; their lines are not joined.

The arrays go to the tasks as a broadcast while their size, known from the
count of hashes, is within a bound.  Beyond it, the hashes of the most common
lines still go so (as many as the bound allows), and the remaining lines send
only (hash, doc_id) to the shard that holds them, which answers with the
documents' repeated lines.  The probes of a shard are counted and dealt to
blocks of bounded size, and each block gets a copy of the shard.

Defined cases: a null or empty text is one empty line; every row counts as one
document, also if its id repeats; a null doc_id ranks below all others; an
empty table gives no rows; columns of the input other than text stay, those
named n_lines or n_dropped are replaced; a very long text is split like any
other, one batch of rows at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memloom.llm.common import bounded_broadcast, free_name, sliced, worker_held, written

WHITE = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NO_ID = -(2**63)
#: Bytes of the arrays for one line, with the hash function: 2.5 + 8 + 4 + 8, rounded up.
LINE_BYTES = 24
SHARD_LINES = 100_000
#: About so many probes meet a shard in one group.
PROBE_ROWS = 1_000_000
GAMMA = 2.0


def line_key(line: str) -> str:
    """The line without white space at its ends, A-Z in lower case."""
    line = line.strip(WHITE)
    return line.lower() if line.isascii() else line.translate(UPPER)


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finalizer, different for each seed."""
    with np.errstate(over="ignore"):
        x = x ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit keys: levels of bit sets, each key at the first level where it is alone."""

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        placed, level = 0, 0
        while len(keys) and level < 48:
            words = max(1, int(np.ceil(GAMMA * len(keys) / 64)))
            at = (mixed(keys, level) % np.uint64(words * 64)).astype(np.int64)
            alone = np.bincount(at, minlength=words * 64) == 1
            bits = np.packbits(alone, bitorder="little").view("<u8")
            ranks = placed + np.concatenate([[0], np.cumsum(np.bitwise_count(bits))[:-1]]).astype(np.int64)
            self.levels.append((words, bits, ranks))
            placed += int(alone.sum())
            keys = keys[~alone[at]]
            level += 1
        self.rest, self.placed = np.sort(keys), placed
        self.size = placed + len(keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The key's place from 0 to size - 1; for other keys some place or -1."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, (words, bits, ranks) in enumerate(self.levels):
            if not len(left):
                return out
            at = mixed(keys[left], level) % np.uint64(words * 64)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            here = (bits[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(bits[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[here]] = ranks[word[here]] + below[here]
            left = left[~here]
        if len(left) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[left]), len(self.rest) - 1)
            same = self.rest[at] == keys[left]
            out[left[same]] = self.placed + at[same]
        return out


class LineShard:
    """A perfect hash with its arrays: fingerprints, counts, largest ids."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray, count: np.ndarray, last: np.ndarray):
        self.hash = PerfectHash(hi)
        at = self.hash.find(hi)
        self.prints, self.counts, self.last = (np.empty(len(hi), dtype=t) for t in ("u8", "u4", "i8"))
        self.prints[at], self.counts[at], self.last[at] = lo, np.minimum(count, 2**32 - 1), last

    def probe(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each line is held here, and the largest id that has it."""
        if not self.hash.size:
            return np.zeros(len(hi), dtype=bool), np.full(len(hi), NO_ID)
        at = self.hash.find(hi)
        return (at >= 0) & (self.prints[at] == lo), self.last[at]


def hashed_lines(texts: list, min_chars: int) -> tuple[list[list[str]], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines of every text; of the long ones: row, line number, and both halves of the hash."""
    worker_held("lines", dict)
    lines, rows, numbers, digests = [], [], [], []
    for row, text in enumerate(texts):
        own = (text or "").split("\n")
        lines.append(own)
        for number, line in enumerate(own):
            if len(line) >= min_chars and len(key := line_key(line)) >= min_chars:
                rows.append(row)
                numbers.append(number)
                digests.append(xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass")))
    halves = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)
    return lines, np.array(rows, dtype=np.int64), np.array(numbers, dtype=np.int64), halves[:, 0], halves[:, 1]


def line_counts(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(hi, lo, n, last) of the long lines that at least min_docs rows hold."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            _, rows, _, hi, lo = hashed_lines(batch.column(1).to_pylist(), min_chars)
            if not len(rows):
                continue
            # A row counts once for each of its lines; then one output row for each line of the batch.
            order = np.lexsort((ids[rows], rows, lo, hi))
            rows, hi, lo = rows[order], hi[order], lo[order]
            first = np.r_[True, (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])]
            new = first | np.r_[True, rows[1:] != rows[:-1]]
            at = np.flatnonzero(first)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hi[at].view("i8")),
                    pa.array(lo[at].view("i8")),
                    pa.array(np.add.reduceat(new.astype(np.int64), at)),
                    pa.array(np.maximum.reduceat(ids[rows], at)),
                ],
                names=["hi", "lo", "n", "last"],
            )

    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, "hi long, lo long, n long, last long")
    return found.groupBy("hi", "lo").agg(F.sum("n").alias("n"), F.max("last").alias("last")).where(F.col("n") >= min_docs)


def shard_of(hi: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(hi, 99) % np.uint64(shards)).astype(np.int64)


def collected_shards(lines: DataFrame, total: int) -> list[LineShard]:
    """The arrays of so many lines, one shard after the other."""
    parts = max(1, -(-total // SHARD_LINES))
    table = lines.select("hi", "lo", "n", "last").toArrow()
    hi, lo = (table[c].to_numpy().view("u8") for c in ("hi", "lo"))
    n, last = table["n"].to_numpy(), table["last"].to_numpy()
    shard = shard_of(hi, parts)
    return [LineShard(hi[shard == s], lo[shard == s], n[shard == s], last[shard == s]) for s in range(parts)]


def probe_all(shards: list[LineShard], hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    shard = shard_of(hi, len(shards))
    held, last = np.zeros(len(hi), dtype=bool), np.full(len(hi), NO_ID)
    for s in np.unique(shard):
        own = shard == s
        held[own], last[own] = shards[s].probe(hi[own], lo[own])
    return held, last


def routed_hits(docs: DataFrame, rare: DataFrame, common, min_chars: int, total_rare: int) -> DataFrame:
    """(doc_id, hits): hashes of the rare repeated lines that a document must lose.

    Lines that the broadcast arrays hold are left out.  Lines on one row probe
    too, so probes grow with the corpus: each shard meets them in blocks of
    about PROBE_ROWS, whatever the number of shards.
    """
    parts = max(1, -(-total_rare // SHARD_LINES))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            _, rows, _, hi, lo = hashed_lines(batch.column(1).to_pylist(), min_chars)
            if len(rows):
                keep = ~probe_all(common.value, hi, lo)[0]
                rows, hi, lo = rows[keep], hi[keep], lo[keep]
                # Copies of a line differ in their places, so that those of one id are dealt as well.
                deal = mixed(hi ^ mixed(ids[rows].view("u8"), 97) ^ np.arange(len(rows), dtype="u8"), 98) >> np.uint64(33)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard_of(hi, parts)), pa.array(deal.astype(np.int32)), pa.array(hi.view("i8")), pa.array(lo.view("i8")), pa.array(ids[rows])],
                    names=["shard", "deal", "hi", "lo", "doc_id"],
                )

    def answer(own: pa.Table, probes: pa.Table) -> pa.Table:
        cols = {c: own[c].to_numpy() for c in ("hi", "lo", "n", "last")}
        shard = LineShard(cols["hi"].view("u8"), cols["lo"].view("u8"), cols["n"], cols["last"])
        hi, lo, ids = (probes[c].to_numpy() for c in ("hi", "lo", "doc_id"))
        held, last = shard.probe(hi.view("u8"), lo.view("u8"))
        held &= last != ids
        return pa.table({"doc_id": ids[held], "hi": hi[held], "lo": lo[held]})

    def with_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = shard_of(batch.column(0).to_numpy().view("u8"), parts)
            yield pa.RecordBatch.from_arrays([pa.array(shard), *batch.columns], names=["shard", "hi", "lo", "n", "last"])

    probes = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(send, "shard long, deal int, hi long, lo long, doc_id long")
    probes = written(probes, "probes")
    blocks = written(probes.groupBy("shard").agg(F.ceil(F.count("*") / PROBE_ROWS).alias("blocks")), "blocks")
    blocks = bounded_broadcast(blocks, 16)
    probes = probes.join(blocks, "shard").select("shard", F.pmod("deal", "blocks").alias("block"), "hi", "lo", "doc_id")
    own = rare.select("hi", "lo", "n", "last").mapInArrow(with_shard, "shard long, hi long, lo long, n long, last long")
    own = own.join(blocks, "shard").select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "hi", "lo", "n", "last")
    hits = own.groupBy("shard", "block").cogroup(probes.groupBy("shard", "block")).applyInArrow(answer, "doc_id long, hi long, lo long")
    return hits.groupBy("doc_id").agg(F.collect_set(F.struct("hi", "lo")).alias("_line_hits"))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, array_bytes: int = 32 << 20, n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """docs with text without repeated lines, and n_lines (before), n_dropped, under names that docs must not have yet (see free_name).

    A line whose key has at least min_chars code points and is on at least
    min_docs rows stays only in rows with the largest doc_id that holds it.
    """
    spark = docs.sparkSession
    if taken := {n_lines.lower(), n_dropped.lower()} & {c.lower() for c in docs.columns}:
        raise ValueError(f"documents have columns {sorted(taken)} of their own")
    counts = written(line_counts(docs, min_chars, min_docs), "lines")
    total, most = counts.count(), max(1, array_bytes // LINE_BYTES)
    if total <= most:
        common, hits = spark.sparkContext.broadcast(collected_shards(counts, total)), None
    else:
        # The commonest lines that fit; the table of line counts by count is small.
        held, least = 0, None
        for row in counts.groupBy("n").agg(F.count("*").alias("lines")).orderBy(F.desc("n")).toLocalIterator():
            if held + row["lines"] > most:
                break
            held, least = held + row["lines"], row["n"]
        often = F.lit(False) if least is None else F.col("n") >= least
        common = spark.sparkContext.broadcast(collected_shards(counts.where(often), held))
        hits = routed_hits(docs, counts.where(~often), common, min_chars, total - held)
        line_id, line_hits = free_name("_line_id", docs), free_name("_line_hits", docs)
        hits = hits.withColumnsRenamed({"doc_id": line_id, "_line_hits": line_hits})

    routed = hits is not None
    names, at, key = docs.columns, docs.columns.index("text"), docs.columns.index("doc_id")
    fields = [T.StructField(f.name, T.StringType() if f.name == "text" else f.dataType, True) for f in docs.schema.fields]
    schema = T.StructType([*fields, T.StructField(n_lines, T.LongType()), T.StructField(n_dropped, T.LongType())])

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ids = batch.column(key).cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            lines, rows, numbers, hi, lo = hashed_lines(batch.column(at).to_pylist(), min_chars)
            held, last = probe_all(common.value, hi, lo)
            lose = held & (last != ids[rows])
            if routed:
                own = [{(h["hi"], h["lo"]) for h in x or ()} for x in batch.column(len(names)).to_pylist()]
                lose |= np.array([(h, l) in own[r] for r, h, l in zip(rows, hi.view("i8").tolist(), lo.view("i8").tolist())], dtype=bool)
            gone: dict[int, set[int]] = {}
            for row, number in zip(rows[lose].tolist(), numbers[lose].tolist()):
                gone.setdefault(row, set()).add(number)
            kept = ["\n".join(x if r not in gone else [y for k, y in enumerate(x) if k not in gone[r]]) for r, x in enumerate(lines)]
            columns = [pa.array(kept, pa.string()) if k == at else batch.column(k) for k in range(len(names))]
            columns += [pa.array([len(x) for x in lines], pa.int64()), pa.array([len(gone.get(r, ())) for r in range(len(lines))], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, n_lines, n_dropped])

    source = docs.select(*names)
    if routed:
        source = docs.join(hits, F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)) == F.col(line_id), "left").select(*names, line_hits)
    return source.mapInArrow(drop, schema)


def line_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of what remains, for every row."""
    kept = dedup_lines(docs.select("doc_id", "text"), **options)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
