"""Runs, ranks, offsets, padding and splits of sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from memloom.tables import free_name, written


def run_ids(df: DataFrame, key: str, order: str, value: str, name: str = "run", width: int = 4096) -> DataFrame:
    """Numbers runs of equal values from 1 within each key; order is a whole number.

    A key may hold much of the table: runs are numbered within ranges of
    `width` values of order, and only the ranges, a row each with its first and
    last value, meet in a key's window, which tells the runs before each range
    and whether its first run goes on from the range before.  Rows without an
    order come first.
    """
    cell = F.coalesce(F.floor(F.col(order) / width), F.lit(-(2**62)))
    inside = Window.partitionBy(key, "_cell").orderBy(order)
    same = F.col(value).eqNullSafe(F.lag(value).over(inside)) & (F.row_number().over(inside) > 1)
    rows = df.withColumn("_cell", cell).withColumn("_new", F.when(same, 0).otherwise(1))
    rows = rows.withColumns({"_run": F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)), "_at": F.row_number().over(inside)}).drop("_new")
    ends = rows.groupBy(key, "_cell").agg(F.min_by(value, "_at").alias("_first"), F.max_by(value, "_at").alias("_last"), F.max("_run").alias("_runs"))
    along = Window.partitionBy(key).orderBy("_cell")
    goes_on = F.col("_first").eqNullSafe(F.lag("_last").over(along)) & (F.row_number().over(along) > 1)
    ends = ends.withColumn("_on", F.when(goes_on, 1).otherwise(0))
    before = F.coalesce(F.sum(F.col("_runs") - F.col("_on")).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = ends.select(F.col(key).alias("_key"), F.col("_cell").alias("_range"), (before - F.col("_on")).alias("_base"))
    placed = rows.join(ends, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_cell") == F.col("_range")))
    return placed.withColumn(name, (F.col("_base") + F.col("_run")).cast("long")).drop("_cell", "_run", "_at", "_key", "_range", "_base")


def run_counts(df: DataFrame, key: str, value: str, run: str = "run") -> DataFrame:
    return df.groupBy(key, run).agg(F.first(value).alias(value), F.count("*").alias("n"))


def rank_in_run(df: DataFrame, key: str, order: str, run: str = "run", width: int = 4096) -> DataFrame:
    """Each row's place, from 0, in its run; a run may hold much of the table (see exclusive_offsets)."""
    one = free_name("_one", df)
    return exclusive_offsets(df.withColumn(one, F.lit(1)), [key, run], order, one, "rank", width).drop(one)


def exclusive_offsets(df: DataFrame, key: str | list[str], order: str, size: str, name: str = "offset", width: int = 4096) -> DataFrame:
    """The sum of sizes before each row of its key; order is a whole number.

    A key may hold much of the table: sizes are summed within ranges of `width`
    values of order, and only the ranges' sums, a row each, meet in a key's window.
    """
    keys = [key] if isinstance(key, str) else key
    cell, own, base = (free_name(c, df) for c in ("_cell", "_own", "_base"))
    rows = df.withColumn(cell, F.coalesce(F.floor(F.col(order) / width), F.lit(-(2**62))))
    sums = rows.groupBy(*keys, cell).agg(F.sum(size).alias(own))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.withColumn(base, F.coalesce(F.sum(own).over(before(Window.partitionBy(*keys).orderBy(cell))), F.lit(0))).drop(own)
    bases = bases.toDF(*[f"_{k}_" for k in range(len(keys))], "_range", base)
    rows = rows.withColumn(own, F.coalesce(F.sum(size).over(before(Window.partitionBy(*keys, cell).orderBy(order))), F.lit(0)))
    same = rows[cell] == bases["_range"]
    for k, c in enumerate(keys):
        same = same & rows[c].eqNullSafe(bases[f"_{k}_"])
    return rows.join(bases, same).select(*[rows[c] for c in df.columns if c != name], (F.col(base) + F.col(own)).cast("long").alias(name))


def global_offsets(df: DataFrame, order: str, size: str, width: int = 4096) -> DataFrame:
    """number (from 0) and offset (sum of sizes before) of each row over the whole table, in the order of a whole number.

    Rows are summed by ranges of `width` values of order, and only the ranges'
    sums, a row each, meet in one window.
    """
    cell = F.floor(F.col(order) / width)
    sums = df.groupBy(cell.alias("_cell")).agg(F.count("*").alias("_n"), F.sum(size).alias("_s"))
    before = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("_cell", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in ("_n", "_s")])
    inside = Window.partitionBy("_cell").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_cell", cell)
    rows = rows.withColumns({"_k": F.count("*").over(inside), "_o": F.coalesce(F.sum(size).over(inside), F.lit(0))})
    placed = rows.join(base, "_cell")
    return placed.withColumns({"number": F.col("_n0") + F.col("_k"), "offset": (F.col("_s0") + F.col("_o")).cast("long")}).drop("_cell", "_k", "_o", "_n0", "_s0")


def ordinals(df: DataFrame, *by: str | Column, name: str = "ordinal", parts: int | None = None) -> DataFrame:
    """df, written once as a table, with each row's number from 0 in the order of any keys.

    Rows are dealt to ranges of the keys and sorted there; what a row has before
    it is what earlier ranges hold, a row each, and its place in its own range.
    A value that much of the table shares is split by the keys after it, and
    rows that are equal in all of them by where they were read.
    """
    source, at = free_name("_source", df), free_name("_at", df)
    at += "_" * (at == name)
    keys = [*by, source]
    rows = df.withColumn(source, F.monotonically_increasing_id())
    rows = rows.repartitionByRange(parts, *keys) if parts else rows.repartitionByRange(*keys)
    table = written(rows.sortWithinPartitions(*keys).drop(source).withColumn(at, F.monotonically_increasing_id()), "ordinals")
    return numbered(table, at, name)


def ranked(df: DataFrame, key: str, *by: str | Column, name: str = "rank") -> DataFrame:
    """df with each row's number from 0 among those of its key, in the order of any keys; a key may hold much of the table."""
    number, start, own = (free_name(c, df) for c in ("_number", "_start", "_key"))
    rows = ordinals(df, key, *by, name=number)
    starts = rows.groupBy(F.col(key).alias(own)).agg(F.min(number).alias(start))
    placed = rows.join(starts, F.col(key).eqNullSafe(F.col(own)))
    return placed.withColumn(name, F.col(number) - F.col(start)).drop(number, start, own)


def numbered(table: DataFrame, at: str, name: str) -> DataFrame:
    """A table with `at`, a monotonically increasing id of its sorted parts, numbered from 0 over all of it."""
    part = free_name("_part", table)
    sums = table.groupBy(F.shiftright(at, 33).alias(part)).agg(F.count("*").alias("_n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(f"{part}_base"))
    # A row for each task that wrote the table.
    placed = table.withColumn(part, F.shiftright(at, 33)).join(F.broadcast(base), part)
    return placed.withColumn(name, F.col(f"{part}_base") + F.col(at).bitwiseAND((1 << 33) - 1)).drop(part, f"{part}_base", at)


def offset_concat(df: DataFrame, key: str, part: str, local: str) -> DataFrame:
    """Makes ids of parts go on from the part before: adds the largest ids of all parts before."""
    largest = df.groupBy(key, part).agg(F.max(local).alias("_size"))
    bases = exclusive_offsets(largest, key, part, "_size").drop("_size")
    return df.join(bases, [key, part]).withColumn("joined", F.col(local) + F.col("offset")).drop("offset")


def left_pad(df: DataFrame, batch: str, ids: str, pad: int, roles: str | None = None, positions: str | None = None) -> DataFrame:
    """Pads arrays of a batch on the left to its longest; mask is 0 on padding.

    Arrays of roles, where named, are padded with 0, and those of positions
    with their own first position (0 if they have none).
    """
    gap = F.max(F.size(ids)).over(Window.partitionBy(batch)) - F.size(ids)
    before = lambda fill, values: F.concat(F.array_repeat(fill.cast("long"), gap), values)
    out = {"padded": before(F.lit(pad), F.col(ids)), "mask": before(F.lit(0), F.transform(ids, lambda _: F.lit(1).cast("long")))}
    if roles:
        out["padded_roles"] = before(F.lit(0), F.col(roles))
    if positions:
        out["padded_positions"] = before(F.coalesce(F.get(positions, F.lit(0)), F.lit(0)), F.col(positions))
    return df.withColumns(out)


def sub_batches(df: DataFrame, number: str, size: int) -> DataFrame:
    """df with batch: every `size` rows that follow each other by number, which counts from 0 (see global_offsets)."""
    return df.withColumn("batch", F.floor(F.col(number) / size).cast("long"))


def stable_partition(values: Column, mask: Column) -> Column:
    """values with those whose mask is 0 first, both parts in their order; moves padding to the left."""
    part = lambda x: F.filter(values, lambda _, i: F.get(mask, i) == x)
    return F.concat(part(0), part(1))


def local_ids(df: DataFrame, shard: str, order: str) -> DataFrame:
    """df with local: a row's number in its shard, from 0.  Shards are of bounded size."""
    return df.withColumn("local", (F.row_number().over(Window.partitionBy(shard).orderBy(order)) - 1).cast("long"))


def global_ids(found: DataFrame, known: DataFrame, shard: str) -> DataFrame:
    """found (shard, local) with what `known` has under the same numbers."""
    return found.join(known, [shard, "local"])


def shift_labels(labels: Column, length: int, ignore: int = -100) -> Column:
    """Labels moved one to the left, filled with `ignore` to `length`."""
    moved = F.slice(labels, 2, F.greatest(F.size(labels) - 1, F.lit(0)))
    return F.concat(moved, F.array_repeat(F.lit(ignore).cast("long"), F.lit(length) - F.size(moved)))


def sequence_split(values: Column, world: int, rank: int | Column, kind: str) -> Column:
    """A rank's share of a sequence: ulysses takes one of `world` equal pieces, zigzag-ring two of twice as many, from both ends."""
    if kind == "ulysses":
        size = F.floor(F.size(values) / world).cast("int")
        return F.slice(values, F.lit(rank) * size + 1, size)
    if kind == "zigzag-ring":
        size = F.floor(F.size(values) / (2 * world)).cast("int")
        return F.concat(F.slice(values, F.lit(rank) * size + 1, size), F.slice(values, F.lit(2 * world - 1 - rank) * size + 1, size))
    raise ValueError(f"kind must be ulysses or zigzag-ring, not {kind!r}")
