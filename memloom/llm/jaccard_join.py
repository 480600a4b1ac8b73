"""N-gram Jaccard join by universe partition and pigeonhole, to linked groups of documents.

A document is its set of distinct word shingles; two link when the Jaccard
similarity of their sets is at least percent / 100.

Sizes fall into bands.  For the larger set of a linking pair in a band, the
symmetric difference is at most H, a bound of the band.  A hash deals all
shingles to the band's m segments, and a set's part in each segment is hashed to
a signature; in D of the segments, the parts without one shingle are hashed as
well.  If two sets differ by at most H, then in some segment they are equal, or
in one of the D differ by at most one shingle, as long as m + D > H; so they
share a signature.  m and D come from a cost model for the band: more segments
cost rows, while with slack (m + D beyond H + 1) a set may leave out its empty
segments, whose signatures it would share with everybody; only sets with more
empty segments than the slack emit those.  A set emits under its own band
and, if it can be the smaller of a pair, under the next.

Equal sets are one node, so copies cost one row for each task.  Rows (signature,
node) are dealt by ranges of both, so a common signature is spread over
tasks; signatures with one node go at once.  Candidates are first each
signature's nodes with the one among them that shares most signatures, and once
links have joined groups, the pairs that share a signature and are still
apart.  Pairs within a group need no test, since groups are all that is asked
for: none that could join two groups is left out.

Before a candidate is verified by exact intersection, it must pass a bound that
never rejects a link: each node has a sketch, the parity of the number of its
shingles that hash to each of its bits, and two sketches differ in no more bits
than the sets in shingles.  To be compared within signatures, a sketch goes once
to each task that its node's signatures go to, and signatures with one least
node, whose nodes are often the same ones, go to one task.

Shingles and nodes are 64-bit hashes of their contents.  A signature, node or
group that holds many rows is dealt to several tasks wherever it is joined.
Pairs that share a common signature and are in different groups are all
compared, in blocks: that work grows with the square of the signature's groups.

Defined cases: texts that are null or without words have the empty set, which
links with nothing; rows with one id are separate members and may link; a null
id ranks below all others and is returned as null; an empty table gives no rows;
a very long text is one set like any other, and a task holds the words, set and
signatures of one text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memloom.llm.common import bounded_broadcast, discard, free_name, join_unique, sliced, written
from memloom.llm.components import connected_components
from memloom.llm.line_dedup import NO_ID, mixed
from memloom.llm.words import shingles, word_hashes


BITS = 1024


@dataclass(frozen=True)
class Band:
    """Sizes low..high of the larger set; H, segments, of which the first `deleting` emit one-deletion neighbourhoods."""

    number: int
    low: int
    high: int
    most: int
    segments: int
    deleting: int


def largest_difference(size: int, percent: int) -> int:
    """The greatest symmetric difference of linking sets of at most size shingles each."""
    both = np.arange(1, 2 * size + 1)
    return int((both - 2 * -(-percent * both // (100 + percent))).max())


def allocate(number: int, low: int, high: int, percent: int, sets: int) -> Band:
    """The cheapest segments for about so many sets: rows, and pairs that meet in empty segments."""
    most, n, best = largest_difference(high, percent), low * percent / 100, None
    for slack in range(17):
        for deleting in range(most // 2 + 2):
            m = most + 1 + slack - deleting
            if m < 1 or deleting > m:
                continue
            none = (1 - 1 / m) ** n if m > 1 else 0.0
            one = n / m * none
            bad = (m - deleting) * none + 2 * deleting * (none + one)
            term = tail = exp(-bad)
            for k in range(1, slack + 1):
                term *= bad / k
                tail += term
            hard = sets * max(0.0, 1 - tail)
            cost = sets * (m + deleting * n / m) + hard * bad + 4 * m * (hard * none) ** 2
            if best is None or cost < best[0]:
                best = (cost, m, deleting)
            if deleting > 3:
                break
    return Band(number, low, high, most, best[1], best[2])


def bands_up_to(size: int, percent: int, sets: int, growth: float = 1.3) -> list[Band]:
    """Bands over all sizes of sets that can link to a different set."""
    out, low = [], 1
    while largest_difference(low, percent) < 1:
        low += 1
    while low <= size:
        high = max(int(low * growth), -(-low * 100 // percent))
        out.append(allocate(len(out), low, high, percent, sets))
        low = high + 1
    return out


class Signer:
    """Signatures of sets, with the bands made as sizes need them."""

    def __init__(self, percent: int, sets: int):
        self.percent, self.sets, self.bands = percent, sets, bands_up_to(4096, percent, sets)

    def of(self, tokens: np.ndarray) -> np.ndarray:
        n = len(tokens)
        if not n:
            return tokens
        # The greatest size that this set can link with must be in a band.
        most = 100 * n // self.percent
        if most > self.bands[-1].high:
            self.bands = bands_up_to(2 * most, self.percent, self.sets)
        at = int(np.searchsorted([b.high for b in self.bands], n))
        out = [self._under(tokens, self.bands[at])] if n >= self.bands[at].low else []
        for band in self.bands[at + (n >= self.bands[at].low) :]:
            if 100 * n < self.percent * band.low:
                break
            out.append(self._under(tokens, band))
        return np.concatenate(out) if out else tokens[:0]

    def _under(self, tokens: np.ndarray, band: Band) -> np.ndarray:
        m, d = band.segments, band.deleting
        segment = ((mixed(tokens, band.number) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(segment, kind="stable")
        segment, value = segment[order], mixed(tokens, 1 << 20)[order]
        first = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
        held, sums = segment[first], np.add.reduceat(value, first)
        counts = np.diff(np.r_[first, len(segment)])
        contents, places = [sums], [held]
        empty = np.ones(m, dtype=bool)
        empty[held] = False
        lone = held[(held < d) & (counts == 1)]
        lost = int(empty[d:].sum()) + 2 * int(empty[:d].sum()) + 2 * len(lone)
        if d:
            own = np.repeat((held < d) & (counts > 1), counts)
            with np.errstate(over="ignore"):
                contents.append(np.repeat(sums, counts)[own] - value[own])
            places.append(segment[own])
        if m + d - lost <= band.most:
            places.append(np.r_[np.flatnonzero(empty), lone])
            contents.append(np.zeros(len(places[-1]), dtype=np.uint64))
        place = np.concatenate(places).astype(np.uint64) + np.uint64(band.number << 32)
        return np.unique(mixed(np.concatenate(contents) ^ mixed(place, 3), 4))


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parities of the counts of shingles by bit, as 64-bit integers; a power of two of at least one bit a shingle.

    Unrelated sets of one size n then differ in 0.49 n bits, sets that link at 80 % in 0.22 n at most.
    A sketch of twice as many bits folds to the shorter one: its halves' exclusive or.
    """
    bits = max(BITS, 1 << (len(tokens) - 1).bit_length()) if len(tokens) else BITS
    odd = np.bincount((mixed(tokens, 1 << 21) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    return np.bitwise_xor.reduce(bits.reshape(-1, words), axis=0)


def differing_bits(x: np.ndarray, y: np.ndarray) -> int:
    """Of two sketches, the longer one folded."""
    words = min(len(x), len(y))
    # Unsigned, since numpy counts the bits of a signed number's absolute value.
    return int(np.bitwise_count((folded(x, words) ^ folded(y, words)).view(np.uint64)).sum())


def may_link(na, nb, differ, percent: int):
    """Whether sets of these sizes can link if they differ in at least so many shingles; columns or arrays."""
    both = na + nb
    if isinstance(both, Column):
        return differ <= both - 2 * F.ceil(percent * both / (100.0 + percent) - 1e-9)
    return differ <= both - 2 * -(-percent * both // (100 + percent))


def signed_sets(docs: DataFrame, words: int, percent: int, sets: int) -> DataFrame:
    """(id, node, n, sketch, signatures) of every row.  A task gives the signatures of a node once, as far as it remembers nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, signer, seen = word_hashes(), Signer(percent, sets), set()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                nodes, sizes, sketches, signatures = [], [], [], []
                for text in part.column(1).to_pylist():
                    tokens = shingles(known.of(text), words)
                    node = xxhash.xxh3_64_intdigest(tokens.tobytes()) if len(tokens) else None
                    nodes.append(node if node is None else node - (1 << 63))
                    sizes.append(len(tokens))
                    sketches.append(sketch(tokens))
                    if node is None or node in seen:
                        signatures.append([])
                    else:
                        signatures.append(signer.of(tokens).view(np.int64))
                        if len(seen) < 500_000:
                            seen.add(node)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).fill_null(NO_ID), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sketches, pa.list_(pa.int64())), pa.array(signatures, pa.list_(pa.int64()))],
                    names=["id", "node", "n", "sketch", "signatures"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "id long, node long, n long, sketch array<long>, signatures array<long>")


def shared_signatures(signed: DataFrame, parts: int) -> DataFrame:
    """(signature, node) rows whose signature another node has too; the first and last row of a task also stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            s, n = (batch.column(k).to_numpy() for k in (0, 1))
            if not len(s):
                continue
            before = True
            if held is not None:
                s, n, before = np.r_[held[0], s], np.r_[held[1], n], held[2]
            new = np.r_[True, (s[1:] != s[:-1]) | (n[1:] != n[:-1])]
            s, n = s[new], n[new]
            same = s[1:] == s[:-1]
            live = np.r_[before, same] | np.r_[same, False]
            held = (s[-1], n[-1], bool(np.r_[before, same][-1]))
            keep = np.flatnonzero(live[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(s[keep]), pa.array(n[keep])], names=["signature", "node"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held[0]], pa.int64()), pa.array([held[1]], pa.int64())], names=["signature", "node"])

    rows = signed.select(F.explode("signatures").alias("signature"), "node")
    dealt = rows.repartitionByRange(parts, "signature", "node").sortWithinPartitions("signature", "node")
    return dealt.mapInArrow(run, "signature long, node long")


def promising(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Of a table of pairs (a, b), those that may link by their sizes and sketches."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    both = join_unique(pairs, side("a"), "a", pairs.groupBy("a").count())
    both = join_unique(both, side("b"), "b", pairs.groupBy("b").count(), F.xxhash64("a"))
    # Sets of sizes that can link have sketches of one length or of twice the other's.
    fold = lambda x, y: F.when(F.size(x) > F.size(y), F.transform(F.sequence(F.lit(0), F.size(y) - 1), lambda i: F.get(x, i).bitwiseXOR(F.get(x, i + F.size(y))))).otherwise(F.col(x))
    differ = F.aggregate(F.zip_with(fold("sa", "sb"), fold("sb", "sa"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    near = both.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return near.where(may_link(F.col("na"), F.col("nb"), differ, percent)).select("a", "b")


def centre_pairs(shared: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b): each signature's node that shares most signatures, with each of the others that it may link with."""
    degree = shared.groupBy("node").agg(F.count("*").alias("d"))
    ranked = shared.join(degree, "node").groupBy("signature").agg(F.max(F.struct("d", "node")).alias("c"), F.count("*").alias("count"))
    centre = written(ranked.select("signature", F.col("c.node").alias("a"), "count"), "centres")
    joined = join_unique(shared, centre.select("signature", "a"), "signature", centre.select("signature", "count"))
    pairs = written(joined.where("node <> a").select("a", F.col("node").alias("b")).distinct(), "pairs")
    out = written(promising(pairs, nodes, percent), "stars")
    discard(centre)
    discard(pairs)
    return out


def near_rows(i: np.ndarray, j: np.ndarray, n: np.ndarray, levels: dict[int, tuple[np.ndarray, np.ndarray]], whole, percent: int) -> np.ndarray:
    """Which pairs of rows may link: by sketches of 16 words, of more where both have them, then by the whole ones."""
    fit = np.ones(len(i), dtype=bool)
    words = whole[1]
    for level, (place, bits) in levels.items():
        at = np.flatnonzero(fit & (np.minimum(words[i], words[j]) >= level))
        x, y = i[at], j[at]
        fit[at] = may_link(n[x], n[y], np.bitwise_count(bits[place[x]] ^ bits[place[y]]).sum(1, dtype=np.int64), percent)
    for k in np.flatnonzero(fit & ~np.isin(np.minimum(words[i], words[j]), list(levels))).tolist():
        x, y = i[k], j[k]
        own = [whole[0][whole[2][r] : whole[2][r] + words[r]] for r in (x, y)]
        fit[k] = may_link(n[x], n[y], differing_bits(*own), percent)
    return fit


def dealt(placed: DataFrame, apart: DataFrame, nodes: DataFrame, block_bytes: int) -> DataFrame:
    """(task, node, root, n, sketch, held): each task's nodes, once, with its signatures that they hold.

    placed: signature, node, root.  apart: signature, count, size (bytes of its
    rows), least (node) of the signatures to deal.  Those with one least node go
    together, in parts of about block_bytes.  One that holds more is cut into
    blocks, and each two of them meet in a task of their own; held then has the
    row's side (1 or 2; 0: all pairs).
    """
    bundles = 1 + (apart.agg(F.sum("size")).first()[0] or 0) // block_bytes
    whole = apart.where(F.col("size") <= block_bytes).groupBy("least").agg(F.ceil(F.sum("size") / block_bytes).alias("parts"))
    parted = apart.join(whole.where("parts > 1"), "least", "left")
    one = F.when(F.col("parts").isNull(), F.pmod("least", F.lit(bundles))).otherwise(F.xxhash64("least", F.pmod(F.xxhash64("signature"), "parts")))
    parted = parted.select("signature", F.ceil(F.col("size") / block_bytes).alias("blocks"), one.alias("one"))
    rows = join_unique(placed.select("signature", "node", "root"), parted, "signature", apart.select("signature", "count"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), "blocks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(low == high, 0).when(F.col("own") == low, 1).otherwise(2).cast("byte")
    task = F.when(F.col("blocks") == 1, F.col("one")).otherwise(F.xxhash64("signature", low, high))
    rows = rows.select("node", "root", task.alias("task"), F.struct("signature", side.alias("side")).alias("held"))
    # By node alone, so that neither the grouping nor the join moves rows again.
    rows = rows.repartition("node").groupBy("node", "root", "task").agg(F.collect_list("held").alias("held"))
    return rows.join(nodes.select("node", "n", "sketch"), "node").select("task", "node", "root", "n", "sketch", "held")


def open_pairs(shared: DataFrame, groups: DataFrame, tested: DataFrame, nodes: DataFrame, percent: int, block_bytes: int = 2 << 20) -> DataFrame:
    """(a, b): nodes that share a signature, are in different groups, may link, and are not tested."""
    placed = shared.join(groups, "node", "left").join(nodes.select("node", (64 + 8 * F.size("sketch")).alias("bytes")), "node")
    placed = written(placed.select("signature", "node", F.coalesce("root", "node").alias("root"), "bytes"), "placed")
    apart = placed.groupBy("signature").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("count"), F.sum("bytes").alias("size"), F.min("node").alias("least"))
    apart = written(apart.where("x <> y").select("signature", "count", "size", "least"), "apart")
    rows = dealt(placed, apart, nodes, block_bytes)

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        node, root, n = (group[c].to_numpy() for c in ("node", "root", "n"))
        column = group["sketch"].chunk(0)
        flat, ends = column.flatten().to_numpy().view(np.uint64), column.offsets.to_numpy()
        starts, words = (ends[:-1] - ends[0]).astype(np.int64), np.diff(ends)
        levels, level = {}, BITS // 64
        while level <= words.max():
            place, bits = np.zeros(len(n), dtype=np.int64), []
            for size in np.unique(words[words >= level]):
                at = np.flatnonzero(words == size)
                place[at] = np.arange(len(at)) + sum(map(len, bits))
                found = flat[starts[at][:, None] + np.arange(size)]
                bits.append(np.bitwise_xor.reduce(found.reshape(len(at), -1, level), axis=1))
            levels[level] = (place, np.concatenate(bits))
            level *= 4
        held = group["held"].chunk(0)
        signature, side = (held.flatten().field(k).to_numpy() for k in (0, 1))
        row = np.repeat(np.arange(len(node)), np.diff(held.offsets.to_numpy()))
        order = np.argsort(signature, kind="stable")
        signature, side, row = signature[order], side[order], row[order]
        new = np.r_[True, signature[1:] != signature[:-1]]
        last = np.r_[np.flatnonzero(new)[1:], len(row)][np.cumsum(new) - 1]
        out: tuple[list, list] = ([np.zeros(0, np.int64)], [np.zeros(0, np.int64)])
        left, step = np.arange(len(row)), 1
        while len(left := left[left + step < last[left]]):
            i, j = row[left], row[left + step]
            near = (root[i] != root[j]) & ((side[left] == 0) | (side[left] != side[left + step])) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
            i, j = i[near], j[near]
            fit = near_rows(i, j, n, levels, (flat, words, starts), percent)
            out[0].append(np.minimum(node[i[fit]], node[j[fit]]))
            out[1].append(np.maximum(node[i[fit]], node[j[fit]]))
            step += 1
        return pa.table({"a": np.concatenate(out[0]), "b": np.concatenate(out[1])})

    pairs = rows.groupBy("task").applyInArrow(compare, "a long, b long").distinct()
    done = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    out = written(pairs.join(done, ["a", "b"], "left_anti"), "rest")
    discard(placed)
    discard(apart)
    return out


def verified(docs: DataFrame, pairs: DataFrame, first: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs that link, by exact intersection.  first: (node, id) of one row for each node.

    Each set that some pair needs is made once; pairs take b's set to a's, and a
    node in many pairs is dealt to several tasks.
    """
    ends = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "ends")
    ids = written(ends.join(first, "node").select(F.col("id").alias("need_id")).distinct(), "ids")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.col("text").cast("string").alias("text"))
    found = rows.join(bounded_broadcast(ids, 32), F.col("id") == F.col("need_id"), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            nodes, sets, size = [], [], 0
            for text in batch.column(0).to_pylist():
                tokens = shingles(word_hashes().of(text), words)
                if len(tokens):
                    nodes.append(xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63))
                    sets.append(tokens.view(np.int64))
                    size += len(tokens)
                if size > 1 << 19:
                    yield pack(nodes, sets)
                    nodes, sets, size = [], [], 0
            yield pack(nodes, sets)

    def pack(nodes: list, sets: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "tokens"])

    sets = found.mapInArrow(run, "node long, tokens array<long>").join(ends, "node", "left_semi")
    sets = written(sets.dropDuplicates(["node"]), "sets")
    both = join_unique(pairs, sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b", pairs.groupBy("b").count())
    both = join_unique(both, sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a", pairs.groupBy("a").count(), F.xxhash64("b"))
    common = F.size(F.array_intersect("x", "y"))
    linked = 100 * common >= percent * (F.size("x") + F.size("y") - common)
    out = written(both.where(linked).select("a", "b"), "links")
    for table in (ends, ids, sets):
        discard(table)
    return out


def members(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(id, node, n, least) of every row: its id, set, size of its set, and the smallest id that links reach."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = written(signed_sets(docs, words, percent, max(1, docs.count())), "signed")
    shared = written(shared_signatures(every, parts), "shared")
    signed = written(every.drop("signatures"), "sets")
    discard(every)
    nodes = written(signed.where("node is not null").groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "nodes")
    first = nodes.select("node", "id")
    stars = centre_pairs(shared, nodes, percent)
    links = verified(docs, stars, first, words, percent)
    groups = connected_components(links)
    rest = open_pairs(shared, groups, stars, nodes, percent)
    if not rest.isEmpty():
        links = links.unionByName(verified(docs, rest, first, words, percent))
        groups = connected_components(links)
    for table in (shared, stars, rest):
        discard(table)
    rooted = nodes.join(groups, "node", "left").select("node", "id", F.coalesce("root", "node").alias("root"))
    least = written(rooted.groupBy("root").agg(F.min("id").alias("least"), F.count("*").alias("count")), "least")
    label = join_unique(rooted, least.select("root", "least"), "root", least.select("root", "count")).select("node", "least")
    counts = signed.where("node is not null").groupBy("node").count()
    known = join_unique(signed.where("node is not null").select("id", "node", "n"), label, "node", counts)
    none = signed.where("node is null").select("node", "id", "n", F.col("id").alias("least"))
    return known.select("id", "node", "n", "least").unionByName(none)


def linked_groups(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the size of its set, and the smallest doc_id that links reach."""
    null = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return members(docs, words, percent).select(null("id").alias("doc_id"), F.col("n").alias("n_shingles"), null("least").alias("component_id"))


def with_node(docs: DataFrame, name: str, words: int) -> DataFrame:
    """docs with each row's node in a column of that name."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sets = [shingles(word_hashes().of(t), words) for t in batch.column(at).to_pylist()]
            nodes = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.int64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs without the rows of a group but those with its smallest doc_id.

    Rows go by id; of an id some of whose rows stay, each row goes or stays by its own set.
    """
    rows = written(members(docs, words, percent).select("id", "node", (F.col("id") != F.col("least")).alias("gone")), "members")
    by_id = rows.groupBy("id").agg(F.min("gone").alias("all"), F.max("gone").alias("some"))
    by_id = written(by_id.where("some"), "gone")
    key, node = free_name("gone_id", docs), free_name("gone_node", docs)
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    kept = docs.join(bounded_broadcast(by_id.select(F.col("id").alias(key)), 32), own == F.col(key), "left_anti")
    mixed = by_id.where("not all").select(F.col("id").alias(key))
    if mixed.isEmpty():
        return kept
    gone = rows.where("gone").select(F.col("id").alias(key), F.col("node").alias(f"{node}_")).distinct()
    some = with_node(docs.join(bounded_broadcast(mixed, 32), own == F.col(key), "left_semi"), node, words)
    some = some.join(gone, (own == F.col(key)) & F.col(node).eqNullSafe(F.col(f"{node}_")), "left_anti")
    return kept.unionByName(some.drop(node))
