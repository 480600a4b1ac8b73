"""Bags and buckets of a whole table: largest-fit packing, and least-loaded buckets.

What largest-fit packing puts together follows from the histogram of sizes
alone.  Least-loaded buckets look at one item after the other; ranges of items
guess how full the buckets are when they begin from the last items before them,
and are folded again while the range before them says otherwise.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from heapq import heapify, heapreplace
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from memloom.operators.sequences import ordinals, sequence_split
from memloom.tables import discard, free_name, written


def filled(sizes: list[int], loads: list[int]) -> tuple[list[int], list[int]]:
    """Each item's bucket, the one with the least so far, ties to the first; and how much more than the emptiest each bucket holds in the end."""
    n = len(loads)
    heap = [load * n + b for b, load in enumerate(loads)]
    heapify(heap)
    out = [heapreplace(heap, heap[0] + size * n) % n for size in sizes]
    least = heap[0] // n
    return out, [x // n - least for x in sorted(heap, key=lambda x: x % n)]


def balanced(sizes: list[int], buckets: int) -> list[int]:
    return filled(sizes, [0] * buckets)[0]


def balanced_buckets(df: DataFrame, order: list, size: str, buckets: int, name: str = "bucket", width: int = 1 << 16, place: str | None = None) -> DataFrame:
    """df with each item's bucket: over the whole table in the given order, the one with the least so far, ties to the first.

    place: a column for each item's place, from 0, when the buckets follow each
    other, each in the given order.

    Sizes are whole numbers from 0, null counting as 0.  Only the differences
    between the buckets decide.  Ties, in which buckets take turns by number,
    bring folds from two states together, if the states' sums leave the same
    rest by the number of buckets, in units of what divides all sizes.  So every
    range of `width` items learns how it is entered by folding the last quarter
    of the range before it, from buckets that are level but for that rest.  It
    is folded from there, and again as long as the range before it is left in
    another state; at worst, as with sizes that hardly ever tie, that goes
    through all ranges one after the other.
    """
    number, cell = free_name("_number", df), free_name("_cell", df)
    rows = ordinals(df, *order, name=number).withColumn(cell, F.floor(F.col(number) / width))
    held = rows.select(F.col(cell).alias("cell"), F.col(number).alias("number"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("size"))
    tail = width - width // 4

    def in_order(group: pa.Table) -> list[int]:
        at = group["number"].to_numpy()
        sizes = np.empty(len(at), np.int64)
        sizes[at - at.min()] = group["size"].to_numpy()
        return sizes.tolist()

    def left(group: pa.Table, begin: pa.Table) -> pa.Table:
        # Of the last range, which none follows, only the items may come.
        end = [filled(in_order(group), e.as_py())[1] for e in begin["entered"]]
        return pa.table({"cell": begin["cell"], "entered": begin["entered"].cast(pa.list_(pa.int64())), "left": pa.array(end, pa.list_(pa.int64()))})

    def folded(items: DataFrame, begin: DataFrame) -> DataFrame:
        return items.groupBy("cell").cogroup(begin.groupBy("cell")).applyInArrow(left, "cell long, entered array<long>, left array<long>")

    def numbered(group: pa.Table, entry: pa.Table) -> pa.Table:
        """The items' buckets and places among the range's items of their buckets; the last item tells how the range is left."""
        own, end = filled(in_order(group), entry["entered"][0].as_py())
        own = np.array(own, np.int64)
        first, n = group["number"].to_numpy().min(), len(own)
        by, at = np.argsort(own, kind="stable"), np.empty(n, np.int64)
        at[by] = np.arange(n) - np.searchsorted(own[by], own[by])
        last = pa.array([None] * (n - 1) + [end], pa.list_(pa.int64()))
        return pa.table({"cell": pa.array(np.full(n, entry["cell"][0].as_py())), "number": pa.array(first + np.arange(n)), "own": pa.array(own), "at": pa.array(at), "left": last})

    def placed(items: DataFrame, begin: DataFrame) -> DataFrame:
        return items.groupBy("cell").cogroup(begin.groupBy("cell")).applyInArrow(numbered, "cell long, number long, own long, at long, left array<long>")

    guess = written(_guesses(held, buckets, width, tail, folded), "guess")
    parts = written(placed(held, guess), "buckets")
    states = written(parts.where("left IS NOT NULL").select("cell", "left").join(guess, "cell").select("cell", "entered", "left"), "states")
    mends = 0
    while True:
        before = states.select((F.col("cell") + 1).alias("cell"), F.col("left").alias("due"))
        wrong = written(states.join(before, "cell").where("entered != due").select("cell", F.col("due").alias("entered")), "wrong")
        if wrong.isEmpty():
            discard(wrong)
            break
        mends += 1
        again = folded(held.join(wrong.select("cell"), "cell", "left_semi"), wrong)
        mended = written(states.join(wrong, "cell", "left_anti").unionByName(again), "states")
        discard(states, wrong)
        states = mended
    if mends:
        changed = states.join(guess.withColumnRenamed("entered", "guessed"), "cell").where("entered != guessed").select("cell", "entered")
        again = placed(held.join(changed.select("cell"), "cell", "left_semi"), changed)
        parts = parts.join(changed.select("cell"), "cell", "left_anti").unionByName(again)
    found = [F.col("number").alias(number), F.col("own").alias(name)]
    if place:
        # A row for each range and bucket.
        counts = parts.groupBy("cell", "own").agg(F.count("*").alias("n"))
        before = F.sum("n").over(Window.orderBy("own", "cell").rowsBetween(Window.unboundedPreceding, -1))
        parts = parts.join(written(counts.select("cell", "own", F.coalesce(before, F.lit(0)).alias("base")), "bases"), ["cell", "own"])
        found.append((F.col("base") + F.col("at")).alias(place))
    return rows.drop(cell, name, *[place] if place else []).join(parts.select(*found), number).drop(number)


def _guesses(held: DataFrame, buckets: int, width: int, tail: int, folded: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """cell, entered: how each range is probably entered, from a fold over the items of the one before it from place `tail` on."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What runs of one range's items add up to, before the tail and in all, and what divides them."""
        for batch in batches:
            number, size = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            at = np.flatnonzero(np.diff(number // width, prepend=-1))
            if len(at):
                sums = [np.add.reduceat(np.where(number % width < tail, size, 0), at), np.add.reduceat(size, at), np.gcd.reduceat(size, at)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (number[at] // width, *sums)], names=["cell", "head", "total", "unit"])

    sums = written(held.select("number", "size").mapInArrow(summed, "cell long, head long, total long, unit long"), "sums")
    unit = gcd(*(r["unit"] for r in sums.select("unit").distinct().collect())) or 1
    cells = sums.groupBy("cell").agg(F.try_sum("head").alias("head"), F.try_sum("total").alias("total"))
    # A row for each range.
    before = F.try_sum("total").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    rest = F.pmod(F.floor((F.coalesce(before, F.lit(0)) + F.coalesce("head", F.lit(0))) / unit), F.lit(buckets))
    level = F.transform(F.sequence(F.lit(0), F.lit(buckets - 1)), lambda b: F.when(b < rest, F.lit(unit)).otherwise(F.lit(0)).cast("long"))
    begins = cells.select("cell", level.alias("entered"))
    ends = folded(held.where(F.col("number") % width >= tail), begins.join(cells.select((F.col("cell") - 1).alias("cell")), "cell", "left_semi"))
    first = cells.where("cell = 0").select("cell", F.array_repeat(F.lit(0).cast("long"), buckets).alias("entered"))
    return first.unionByName(ends.select((F.col("cell") + 1).alias("cell"), F.col("left").alias("entered")))


def templates(counts: dict[int, int], capacity: int) -> list[tuple[int, int, dict[int, int]]]:
    """(first bag, how many bags, items of each size in one of them) of largest-fit packing, from how many items each size has.

    What goes into a bag follows from the sizes that are left, so bags are alike
    until one of these sizes runs out: as many are written off at once.
    """
    left = {s: n for s, n in counts.items() if n and 0 <= s <= capacity}
    sizes, out, bag = sorted(left), [], 0
    while sizes:
        room, uses = capacity, {}
        at = bisect_right(sizes, room)
        while at:
            size = sizes[at - 1]
            own = min(left[size], room // size) if size else left[size]
            if own:
                uses[size] = own
                room -= own * size
            at = min(at - 1, bisect_right(sizes, room))
        times = 1 if 0 in uses else min(left[s] // n for s, n in uses.items())
        out.append((bag, times, uses))
        bag += times
        for s, n in uses.items():
            left[s] -= n * times
        sizes = [s for s in sizes if left[s]]
    return out


def knapsack(df: DataFrame, id: str, size: str, capacity: int, name: str = "bag") -> DataFrame:
    """df with each item's bag in largest-fit packing of the whole table, later ids first; items over the capacity get -1.

    Only the histogram of sizes, at most `capacity` and one values, decides what
    bags hold.  Items are ranked within their size, over all tasks, and looked up
    in what the fold says of it.
    """
    spark = df.sparkSession
    number, begins = free_name("_number", df), free_name("_begins", df)
    fits = (F.col(size) >= 0) & (F.col(size) <= capacity)
    counts = df.where(fits).groupBy(F.col(size).cast("long").alias("s")).count().collect()
    made = templates({r["s"]: r["count"] for r in counts}, capacity)
    used, rows = {}, []
    for first, times, uses in made:
        for s, n in uses.items():
            begin = used.get(s, 0)
            used[s] = begin + n * times
            rows.append((s, begin, used[s], first, n))
    # Bounded by the sizes: a row for each size of each kind of bag.
    plan = F.broadcast(spark.createDataFrame(rows, "_s long, _from long, _to long, _first long, _each long"))
    placed = ordinals(df, F.when(fits, F.col(size).cast("long")).otherwise(-1), F.desc(id), name=number)
    starts = placed.where(fits).groupBy(F.col(size).cast("long").alias("_of")).agg(F.min(number).alias(begins))
    ranked = placed.join(F.broadcast(starts), (F.col(size) == F.col("_of")) & fits, "left")
    q = F.col(number) - F.col(begins)
    found = ranked.join(plan, (F.col(size) == F.col("_s")) & fits & (q >= F.col("_from")) & (q < F.col("_to")), "left")
    bag = F.col("_first") + F.floor((q - F.col("_from")) / F.col("_each"))
    return found.select(*df.columns, F.coalesce(bag, F.lit(-1)).cast("long").alias(name))


def packed_examples(df: DataFrame, id: str, cutoff: int, pad: int, ignore: int = -100) -> DataFrame:
    """bag, input_ids, labels, attention_mask, position_ids of length `cutoff`.  df: id, input_ids, labels (arrays of one length).

    Examples of cutoff - 1 tokens or more are left out.  Those of a bag follow
    each other by id; each counts its own positions; labels move one to the left;
    the rest is padded by column: ids, ignored labels, no attention, last position.
    """
    kept = df.where(F.size("input_ids") < cutoff - 1).withColumn("_size", F.size("input_ids").cast("long"))
    rows = knapsack(kept, id, "_size", cutoff - 1)
    # Empty examples, of which one bag may have any number, add nothing to the lists.
    one = F.when(F.col("_size") > 0, F.struct(id, "input_ids", "labels"))
    whole = rows.groupBy("bag").agg(F.array_sort(F.collect_list(one)).alias("_x"))
    joined = lambda field: F.flatten(F.transform("_x", lambda x: x[field]))
    places = F.flatten(F.transform("_x", lambda x: F.transform(x["input_ids"], lambda _, k: k.cast("long"))))
    ids, labels = joined("input_ids"), joined("labels")
    moved = F.slice(labels, 2, F.greatest(F.size(labels) - 1, F.lit(0)))
    fill = lambda c, value: F.concat(c, F.array_repeat(F.lit(value).cast("long"), cutoff - F.size(c)))
    mask = F.transform(ids, lambda _: F.lit(1).cast("long"))
    return whole.select("bag", fill(ids, pad).alias("input_ids"), fill(moved, ignore).alias("labels"), fill(mask, 0).alias("attention_mask"), fill(places, cutoff - 1).alias("position_ids"))


def split_columns(df: DataFrame, world: int, rank: int | Column, kind: str) -> DataFrame:
    """A rank's share of every column of packed examples; masks are the same for all."""
    return df.withColumns({c: sequence_split(F.col(c), world, rank, kind) for c in ("input_ids", "labels", "position_ids")})


def training_shares(df: DataFrame, id: str, seed: int, cutoff: int, pad: int, world: int, kind: str) -> DataFrame:
    """bag, rank and each rank's share of packed examples, shuffled by seed.  df: id, input_ids, labels.

    A hash of seed and id, then the id, is the order in which examples are taken.
    """
    mixed = ordinals(df.withColumn("_mixed", F.xxhash64(F.lit(seed), F.col(id))), "_mixed", id, name="_at").drop("_mixed")
    packed = packed_examples(mixed, "_at", cutoff, pad).withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(world - 1))))
    return split_columns(packed, world, F.col("rank"), kind)
