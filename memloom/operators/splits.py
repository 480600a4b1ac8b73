"""Blocks and slices of a whole table, though each begins where the one before it ends.

A splitter is an automaton: what it does to a range of rows depends only on how
full the open part is when the range begins, which is one of a bounded number of
states.  So each task works out, for every state that a range of rows can be
entered in, the state it is left in and the parts closed on the way: from a row at
which a part begins the next beginning is found by a search in prefix sums, and all
chains are followed at once by doubling their steps.  These tables compose: groups
of ranges become one table, level by level, until one task holds the top.  On the
way down every range learns its own state and number, and a second pass over the
rows numbers them.  The rows go to two shuffles, whatever their number; a level is a
table of (states) entries for each range.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memloom.operators.sequences import ordinals
from memloom.tables import discard, free_name, written

TABLE = "cell long, up long, out array<int>, closed array<long>"


def _followed(after: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """For each beginning the last one of its chain before `end`, and the steps to it."""
    here = np.arange(len(after))
    last, steps = np.where(after < end, after, here), (after < end).astype(np.int64)
    while True:
        further = last[last]
        if np.array_equal(further, last):
            return last, steps
        steps, last = steps + steps[last], further


@dataclass(frozen=True)
class Blocks:
    """A block is closed before a row that would take it over the cap; a row over the cap has one of its own.

    States: the open block's total up to the cap, one for more, one for no block yet.
    """

    cap: int

    @property
    def start(self) -> int:
        return self.cap + 2

    def _after(self, p: np.ndarray) -> np.ndarray:
        n = len(p) - 1
        return np.maximum(np.searchsorted(p, p[:n] + self.cap, "right") - 1, np.arange(n) + 1)

    def _first(self, p: np.ndarray, state: np.ndarray) -> np.ndarray:
        """The row before which a block that is open in this state is closed; the number of rows if none is."""
        return np.searchsorted(p[1:], np.where(state > self.cap, -1, self.cap - state), "right")

    def table(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = np.r_[0, np.cumsum(sizes)]
        n = len(sizes)
        last, steps = _followed(self._after(p), n)
        state = np.arange(self.cap + 2)
        j = self._first(p, state)
        within = np.minimum(j, n - 1)
        out = np.where(j < n, p[n] - p[last[within]], state + p[n])
        closed = np.where(j < n, 1 + steps[within], 0)
        return np.r_[np.minimum(out, self.cap + 1), min(p[n] - p[last[0]], self.cap + 1)].astype(np.int32), np.r_[closed, steps[0]]

    def numbers(self, sizes: np.ndarray, state: int, before: int) -> np.ndarray:
        p = np.r_[0, np.cumsum(sizes)]
        after, n, begins = self._after(p).tolist(), len(sizes), np.zeros(len(sizes), np.int64)
        j = 0 if state == self.start else int(self._first(p, np.array([state]))[0])
        while j < n:
            begins[j] = 1
            j = after[j]
        return before + np.cumsum(begins) - (state == self.start)


@dataclass(frozen=True)
class Slices:
    """A slice is closed after the row with which it reaches the threshold.  States: the open slice's total."""

    threshold: int

    @property
    def start(self) -> int:
        return 0

    def table(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = np.r_[0, np.cumsum(sizes)]
        n = len(sizes)
        last, steps = _followed(np.searchsorted(p, p + self.threshold, "left"), n + 1)
        state = np.arange(self.threshold)
        m = np.searchsorted(p, self.threshold - state, "left")
        within = np.minimum(m, n)
        out = np.where(m <= n, p[n] - p[last[within]], state + p[n])
        return out.astype(np.int32), np.where(m <= n, 1 + steps[within], 0)

    def numbers(self, sizes: np.ndarray, state: int, before: int) -> np.ndarray:
        p = np.r_[0, np.cumsum(sizes)]
        after, n, begins = np.searchsorted(p, p + self.threshold, "left").tolist(), len(sizes), np.zeros(len(sizes) + 1, np.int64)
        m = int(np.searchsorted(p, self.threshold - state, "left"))
        while m <= n:
            begins[m] = 1
            m = after[m]
        return before + np.cumsum(begins)[:n]


def _composed(group: pa.Table) -> pa.Table:
    """The table of ranges that follow each other."""
    group = group.sort_by("cell")
    out, closed = None, None
    for o, c in zip(group["out"], group["closed"]):
        o, c = o.values.to_numpy(zero_copy_only=False), c.values.to_numpy(zero_copy_only=False)
        out, closed = (o, c) if out is None else (o[out], closed + c[out])
    return pa.table({"cell": group["up"][:1], "out": pa.array([out], pa.list_(pa.int32())), "closed": pa.array([closed], pa.list_(pa.int64()))})


def _entered(tables: pa.Table, begin: pa.Table) -> pa.Table:
    """cell, state, before of each range of a group that is entered so."""
    tables = tables.sort_by("cell")
    state, before = begin["state"][0].as_py(), begin["before"][0].as_py()
    states, befores = [], []
    for o, c in zip(tables["out"], tables["closed"]):
        states.append(state)
        befores.append(before)
        state, before = o.values[state].as_py(), before + c.values[state].as_py()
    return pa.table({"cell": tables["cell"], "state": pa.array(states, pa.int64()), "before": pa.array(befores, pa.int64())})


def _entries(tables: DataFrame, cells: int, start: int, fan: int) -> tuple[DataFrame, tuple[int, int]]:
    """cell, state, before of all ranges, and the state and number in which the last one is left."""
    spark = tables.sparkSession
    if cells > fan:
        above = tables.groupBy("up").applyInArrow(_composed, "cell long, out array<int>, closed array<long>")
        above = written(above.withColumn("up", F.floor(F.col("cell") / fan)).select("cell", "up", "out", "closed"), "composed")
        begin, end = _entries(above, -(-cells // fan), start, fan)
        begin = begin.withColumnRenamed("cell", "up")
    else:
        top = tables.select(F.lit(0).cast("long").alias("up"), "cell", "out", "closed").groupBy("up").applyInArrow(_composed, "cell long, out array<int>, closed array<long>")
        last = top.select(F.get("out", F.lit(start)), F.get("closed", F.lit(start))).first()
        end = (last[0], last[1])
        begin = spark.createDataFrame([(0, start, 0)], "up long, state long, before long")
    return written(tables.groupBy("up").cogroup(begin.groupBy("up")).applyInArrow(_entered, "cell long, state long, before long"), "entries"), end


def split(df: DataFrame, splitter: Blocks | Slices, order: list, size: str, name: str, width: int = 1 << 16, fan: int = 128, tail: int = 0) -> DataFrame:
    """df with each row's part, numbered from 0 over the whole table in the given order; sizes are whole numbers from 0, null counting as 0.

    width: rows of a range; fan: ranges of a group.  tail: a last slice of less
    than this, which hasn't reached the threshold, joins the one before.
    """
    number, cell = free_name("_number", df), free_name("_cell", df)
    rows = ordinals(df, *order, name=number).withColumn(cell, F.floor(F.col(number) / width))
    held = rows.select(F.col(cell).alias("cell"), F.col(number).alias("number"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("size"))
    n = held.count()
    if not n:
        return df.withColumn(name, F.lit(None).cast("long"))

    def transition(group: pa.Table) -> pa.Table:
        group = group.sort_by("number")
        out, closed = splitter.table(group["size"].to_numpy())
        cell = group["cell"][:1]
        return pa.table({"cell": cell, "up": pa.array([cell[0].as_py() // fan]), "out": pa.array([out], pa.list_(pa.int32())), "closed": pa.array([closed], pa.list_(pa.int64()))})

    tables = written(held.groupBy("cell").applyInArrow(transition, TABLE), "transitions")
    entries, (state, closed) = _entries(tables, -(-n // width), splitter.start, fan)
    discard(tables)

    def numbered(group: pa.Table, entry: pa.Table) -> pa.Table:
        group = group.sort_by("number")
        own = splitter.numbers(group["size"].to_numpy(), entry["state"][0].as_py(), entry["before"][0].as_py())
        return pa.table({"number": group["number"], "part": pa.array(own, pa.int64())})

    parts = held.groupBy("cell").cogroup(entries.groupBy("cell")).applyInArrow(numbered, "number long, part long")
    part = F.col("part")
    if isinstance(splitter, Slices) and 0 < state < tail and closed:
        part = F.least(part, F.lit(closed - 1))
    named = parts.select(F.col("number").alias(number), part.cast("long").alias(name))
    return rows.drop(cell, name).join(named, number).drop(number)
