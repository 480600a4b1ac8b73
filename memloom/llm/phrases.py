"""Phrase collocations by dynamic itemset counting.

Texts are dealt to a few shards, which are scanned in turn, over and over.  All
words are counted from the first scan on.  After each scan, phrases whose count
so far has reached the threshold are marked with the scan that comes next; a
longer phrase is counted from the scan at which both its subphrases (without its
last and without its first word) are marked, for one full cycle, and then no
more.  So lengths are interleaved: pairs of common words are counted while rarer
words still are.  A phrase with the threshold's count has two subphrases with at
least as much, so none is missed, and each one's count is exact, since the cycle
takes each shard once.

The marks are an array of a fixed number of bytes, addressed by a hash of language
and phrase; the first mark of a byte stays.  Phrases that share a byte are counted
earlier, or in vain, but never twice and never less than a cycle, since a phrase's
first scan follows from the bytes alone.  So what is broadcast never grows, and the
counts need no join: within a task numpy looks up all places of a block of text at
once, tells phrases apart by their words, and hands each distinct one on with its
count; Spark adds them up by language and text.  The state between scans is a table.

Defined cases: a null text is an empty one, without phrases; a null language is
`und`; equal rows count each; a very long text is scanned in blocks at the ends of
pieces or, in a longer piece, of words, with the next words as context, so that no
phrase is lost or counted twice; ties in the ranking go to the larger count, then
to the phrase that comes first in bytes; an empty table gives no rows; other columns
take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from memloom.llm.common import bounded_broadcast, documents, join_unique
from memloom.tables import delete, discard, scratch, written

BLOCKS = "shard int, lang string, block binary, context int, words long"
#: about: what follows from a phrase (see described), so that it is carried and compared as one number.
COUNTED = "lang string, phrase string, about long, n long"


@dataclass(frozen=True)
class Mining:
    """least: count from which a phrase is a candidate; longest: words of a phrase;
    shards: in a cycle; slot_bits: 2^bits bytes of marks; block: bytes of text that are looked at together.
    """

    least: int = 100
    longest: int = 5
    shards: int = 4
    slot_bits: int = 22
    block: int = 1 << 20


def _classes() -> np.ndarray:
    """A-Z in lower case, tabs as blanks, and every sign that ends a piece as a line end."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    table[9] = 32
    table[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 10
    return table


CLASSES = _classes()
SIGNS, PLACES = (np.random.default_rng(k).integers(1, 2**63, n).astype(np.uint64) | np.uint64(1) for k, n in ((1, 256), (2, 64)))


def normalised(text: np.ndarray) -> np.ndarray:
    """Bytes with one blank between words and one line end between pieces, and neither at the ends."""
    b = CLASSES[text]
    gap = (b == 32) | (b == 10)
    b = b[~((b == 32) & np.r_[True, gap[:-1]])] if len(b) else b
    b = b[~((b == 32) & np.r_[b[1:] == 10, True])] if len(b) else b
    b = b[~((b == 10) & np.r_[True, b[:-1] == 10])] if len(b) else b
    return b[:-1] if len(b) and b[-1] == 10 else b


def cut(b: np.ndarray, size: int, longest: int) -> Iterator[tuple[np.ndarray, int]]:
    """Blocks of about `size` bytes and how many of their last words are context only."""
    gaps = np.flatnonzero((b == 32) | (b == 10))
    lines = gaps[b[gaps] == 10]
    at = 0
    while len(b) - at > size:
        k = np.searchsorted(lines, at + size, "right") - 1
        if k >= 0 and lines[k] > at:
            yield b[at : lines[k]], 0
            at = int(lines[k]) + 1
            continue
        k = np.searchsorted(gaps, at + size, "right") - 1
        if k < 0 or gaps[k] <= at:
            k = np.searchsorted(gaps, at + size, "right")
            if k == len(gaps):
                break
        own, end, context = int(gaps[k]), int(gaps[k]), 0
        while b[end] == 32 and context < longest - 1:
            context, k = context + 1, k + 1
            end = int(gaps[k]) if k < len(gaps) else len(b)
            if end == len(b):
                break
        yield b[at:end], context
        at = own + 1
    if at < len(b):
        yield b[at:], 0


def blocks(docs: DataFrame, text: str, lang: str, o: Mining) -> DataFrame:
    """docs' texts by language as blocks (see BLOCKS), dealt to shards in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealt = TaskContext.get().partitionId()
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            part = np.cumsum(size) // (2 * o.block)
            for p in np.unique(part).tolist():
                at = np.flatnonzero(part == p)
                rows = batch.slice(int(at[0]), len(at))
                langs = rows.column(1)
                for name in pc.unique(langs).to_pylist():
                    texts = pc.fill_null(rows.column(0).filter(pc.equal(langs, name)), "").cast(pa.string())
                    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(texts)], texts), "\n")[0].as_buffer()
                    out = []
                    for block, context in cut(normalised(np.frombuffer(joined, np.uint8)), o.block, o.longest):
                        words = int(np.count_nonzero((block == 32) | (block == 10))) + 1 - context
                        out.append((dealt % o.shards, name, block.tobytes(), context, words))
                        dealt += 1
                    if out:
                        columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.string(), pa.binary(), pa.int32(), pa.int64()))]
                        yield pa.RecordBatch.from_arrays(columns, names=["shard", "lang", "block", "context", "words"])

    return docs.select(F.col(text), F.coalesce(F.col(lang), F.lit("und"))).mapInArrow(run, BLOCKS)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64 over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashed(words: pa.StringArray) -> np.ndarray:
    """A hash of each word, none of which is empty: what shares a mark, and no more, hangs on it."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    b = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    starts = offsets[:-1] - offsets[0]
    place = np.arange(len(b)) - np.repeat(starts, np.diff(offsets))
    return mixed(np.add.reduceat(SIGNS[b] * PLACES[place & 63], starts))


def texts_of(b: np.ndarray, first: np.ndarray, end: np.ndarray) -> pa.Array:
    """The stretches of b as strings."""
    length = end - first
    offsets = np.r_[0, np.cumsum(length)]
    at = np.arange(offsets[-1]) + np.repeat(first - offsets[:-1], length)
    return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(b[at]))


def distinct(ids: np.ndarray, at: np.ndarray, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the places `at` are the first of their k words, and how many there are of each; hashes that lie are noticed."""
    found = pa.array(h).dictionary_encode()
    back = found.indices.to_numpy()
    first, n = np.empty(len(found.dictionary), np.int64), np.bincount(back)
    first[back[::-1]] = np.arange(len(back))[::-1]
    if all(np.array_equal(ids[at + j], ids[at[first][back] + j]) for j in range(k)):
        return first, n
    _, first, n = np.unique(np.stack([ids[at + j] for j in range(k)], axis=1), axis=0, return_index=True, return_counts=True)
    return first, n


def count_block(b: np.ndarray, context: int, lang: int, marks: np.ndarray, scan: int, o: Mining) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """k, phrases, the scans they start with, their slots and counts: what is counted of a block in this scan."""
    gap = (b == 32) | (b == 10)
    gaps = np.flatnonzero(gap)
    first, end = np.r_[0, gaps + 1], np.r_[gaps, len(b)]
    piece = np.r_[0, np.cumsum(b[gaps] == 10)]
    # The words without the gaps between them.
    offsets = np.r_[first - np.arange(len(first)), len(b) - len(gaps)].astype(np.int32)
    known = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(b[~gap])).dictionary_encode()
    ids = known.indices.to_numpy()
    own = len(ids) - context
    words = hashed(known.dictionary)
    shift, lang = np.uint64(64 - o.slot_bits), np.uint64(lang)
    slot_of = lambda h: (mixed(h ^ lang) >> shift).astype(np.int64)
    slots = slot_of(words)
    if scan < o.shards:
        n = np.bincount(ids[:own], minlength=len(words))
        some = np.flatnonzero(n)
        yield 1, known.dictionary.take(pa.array(some)), np.zeros(len(some), np.uint8), slots[some], n[some]
    # at: places of (k-1)-word phrases; h: their hashes; mark: the scans that marked them, 0 for none.
    at, h, mark = np.arange(len(ids)), words[ids], marks[slots][ids]
    for k in range(2, o.longest + 1):
        full = np.zeros(len(ids) + 1, np.uint8)
        full[at] = mark
        keep = (at + k <= len(ids)) & (mark > 0) & (full[at + 1] > 0)
        at, h = at[keep], h[keep]
        same = piece[at] == piece[at + k - 1]
        at, h = at[same], h[same]
        if not len(at):
            return
        start = np.maximum(full[at], full[at + 1])
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + words[ids[at + k - 1]])
        slots = slot_of(h)
        active = np.flatnonzero((start > scan - o.shards) & (at < own))
        if len(active):
            one, n = distinct(ids, at[active], h[active], k)
            one = active[one]
            yield k, texts_of(b, first[at[one]], end[at[one] + k - 1]), start[one], slots[one], n
        # One whose byte another phrase marked early can't be extended before it is itself counted.
        mark = marks[slots]
        mark = np.where(mark > 0, np.maximum(mark, start), mark)


def counted(rows: DataFrame, marks: np.ndarray, scan: int, o: Mining) -> tuple[DataFrame, object]:
    """What the scan of a shard's blocks counts (see COUNTED), by block, and the broadcast marks."""
    sent = rows.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for batch in batches:
            for k in range(batch.num_rows):
                lang = batch.column(0)[k].as_py()
                b = np.frombuffer(batch.column(1)[k].as_buffer(), np.uint8)
                for words, phrases, start, slots, n in count_block(b, batch.column(2)[k].as_py(), xxhash.xxh3_64_intdigest(lang), held, scan, o):
                    size = len(phrases)
                    about = slots | (start.astype(np.int64) << 32) | (words << 40)
                    columns = [pa.array([lang]).take(pa.array(np.zeros(size, np.int8))), phrases, pa.array(about), pa.array(n.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "about", "n"])

    return rows.select("lang", "block", "context").mapInArrow(run, COUNTED), sent


def described(about: str) -> tuple[Column, Column, Column]:
    """k, start and slot of a phrase."""
    return F.shiftright(about, 40), F.shiftright(about, 32).bitwiseAND(255), F.col(about).bitwiseAND((1 << 32) - 1)


def frequent(docs: DataFrame, o: Mining, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """lang, phrase, k, n of all phrases of up to `longest` words with n >= least, and lang, n of all words; both are tables."""
    if not 0 < o.shards * o.longest < 255:
        raise ValueError("a mark is one byte: shards times longest must be under 255")
    spark = docs.sparkSession
    path = scratch(spark, "blocks")
    blocks(docs, text, lang, o).write.partitionBy("shard").parquet(path)
    texts = spark.read.schema(BLOCKS).parquet(path)
    totals = written(texts.groupBy("lang").agg(F.sum("words").alias("total")), "totals")
    marks = np.zeros(1 << o.slot_bits, np.uint8)
    k, start, slot = described("about")
    state, scan, last = spark.createDataFrame([], COUNTED), 0, -1
    # What was marked after the scan `last` has had its cycle once as many scans as there are shards have followed.
    while scan <= last + o.shards:
        found, sent = counted(texts.where(F.col("shard") == scan % o.shards), marks, scan, o)
        added = state.unionByName(found).groupBy("lang", "phrase").agg(F.max("about").alias("about"), F.sum("n").alias("n"))
        # Rare phrases go once their cycle is over.
        now = written(added.where((F.col("n") >= o.least) | (start + o.shards - 1 > scan)), "phrases")
        sent.destroy()
        if scan:
            discard(state)
        state = now
        # At most one row for each byte of marks.
        reached = state.where((F.col("n") >= o.least) & (k < o.longest)).select(slot).distinct().toArrow().column(0).to_numpy()
        new = reached[marks[reached] == 0]
        if len(new):
            marks[new], last = scan + 1, scan
        scan += 1
    delete(spark, path)
    return state.where(F.col("n") >= o.least).select("lang", "phrase", k.cast("int").alias("k"), "n"), totals


def score(a: str, n: str, first: str, rest: str) -> Column:
    """floor(1000 a n / (l r)) in whole numbers of up to 38 digits; a is at most l and r, so it fits 64 bits."""
    whole = lambda c: f"cast({c} as decimal(19, 0))"
    return F.expr(f"(cast(1000 as decimal(4, 0)) * {whole(a)} * cast({n} as decimal(15, 0))) div ({whole(first)} * {whole(rest)})")


def looked_up(rows: DataFrame, known: DataFrame, key: str, name: str) -> DataFrame:
    """rows (a table) with the count that a phrase has in its language; a common phrase is dealt to several tasks."""
    counts = rows.groupBy(key).count()
    return join_unique(rows, known.select(F.struct("lang", "phrase").alias(key), F.col("n").alias(name)), key, counts)


def collocations(docs: DataFrame, o: Mining = Mining(), most: int = 2000, text: str = "text", lang: str = "lang", parts: int = 64) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best `most` phrases of each language by their weakest cut.

    Phrases that a longer one covers (every place of the phrase lies in one of the longer) are left out.
    """
    known, totals = frequent(docs, o, text, lang)
    phrases = known.where("k > 1").withColumnRenamed("n", "a")
    split = F.split("phrase", " ")
    join = lambda first, n: F.array_join(F.slice(split, first, n), " ")
    # Whatever is covered by a longer phrase is covered by one with a single word more.
    inside = known.where("k > 2").select("lang", "n", F.explode(F.array(join(F.lit(1), F.col("k") - 1), join(F.lit(2), F.col("k") - 1))).alias("phrase"))
    covers = inside.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    left = phrases.join(covers, ["lang", "phrase"], "left").where("longer is null or longer < a").drop("longer")
    cuts = left.select("lang", "phrase", "k", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    half = lambda c: F.struct(F.col("lang").alias("lang"), c.alias("phrase"))
    cuts = written(cuts.withColumns({"first": half(join(F.lit(1), F.col("cut"))), "rest": half(join(F.col("cut") + 1, F.col("k") - F.col("cut")))}), "cuts")
    halves = written(looked_up(cuts, known, "first", "l"), "halves")
    discard(cuts)
    both = looked_up(halves, known, "rest", "r").select("lang", "phrase", "a", "cut", "l", "r")
    scored = both.join(bounded_broadcast(totals, F.octet_length("lang") + 8), "lang").withColumn("score", score("a", "total", "l", "r"))
    weakest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r")).alias("w"), F.max("a").alias("a"), F.max("total").alias("n"))
    rows = weakest.select("lang", "phrase", "a", "w.l", "w.r", "n", "w.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    near = rows.withColumn("_part", part).withColumn("_at", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_at") <= most)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= most)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


SQL = r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM worded, range(1, 6) r(k) WHERE len(w) >= k),
    f AS (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL),
    totals AS (SELECT lang, sum(n) AS n FROM f WHERE k = 1 GROUP BY lang),
    known AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE n >= 100),
    inside AS (
        SELECT lang, array_to_string(w[i:i + j - 1], ' ') AS phrase, max(n) AS longer
        FROM known, range(2, 5) a(j), range(1, 5) b(i) WHERE k > j AND i + j - 1 <= k GROUP BY ALL
    ), kept AS (SELECT known.* FROM known LEFT JOIN inside USING (lang, phrase) WHERE k > 1 AND (longer IS NULL OR longer < n)),
    cuts AS (SELECT lang, phrase, n AS a, c, array_to_string(w[1:c], ' ') AS x, array_to_string(w[c + 1:k], ' ') AS y FROM kept, range(1, 5) q(c) WHERE c < k),
    scored AS (
        SELECT cuts.lang, cuts.phrase, a, c, x.n AS l, y.n AS r, totals.n AS n, (1000 * a::HUGEINT * totals.n) // (x.n::HUGEINT * y.n) AS score
        FROM cuts JOIN known x ON x.lang = cuts.lang AND x.phrase = cuts.x JOIN known y ON y.lang = cuts.lang AND y.phrase = cuts.y JOIN totals ON totals.lang = cuts.lang
    ), weakest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS pick FROM scored),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest WHERE pick = 1)
    SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""
