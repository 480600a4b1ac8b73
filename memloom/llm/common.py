"""Helpers that several operators share: shared scratch space, size checks, splits."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memloom.tables import discard, free_name, scratch, shared_dir, written

__all__ = ["discard", "free_name", "scratch", "shared_dir", "written"]

#: A side is broadcast only if its measured size is at most this many bytes.
BROADCAST_BYTES = 32 << 20


def bounded_broadcast(df: DataFrame, row_bytes: int | Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if its size, added up now, is in bounds, else df for a shuffled join.

    row_bytes: of the values; a hash table adds about 64 bytes to each row.
    """
    size = df.agg(F.sum(64 + (F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes))).first()[0] or 0
    return F.broadcast(df) if size <= limit else df


def join_unique(many: DataFrame, one: DataFrame, key: str, counts: DataFrame, deal: Column | None = None, most: int = 1000) -> DataFrame:
    """many joined with one, which has one row a key, where a key may hold much of many.

    A key with over `most` rows is dealt to several parts (by `deal`, else by
    all columns), and its row of one is copied to each.  counts: key and count
    of many's rows, as a table.
    """
    hot = counts.where(F.col("count") > most).select(key, F.ceil(F.col("count") / most).alias("_parts"))
    keys = hot.count()
    if not keys:
        return many.join(one, key)
    hot = F.broadcast(hot) if 80 * keys <= BROADCAST_BYTES else hot
    part = F.pmod(F.xxhash64(*many.columns) if deal is None else deal, F.coalesce("_parts", F.lit(1)))
    dealt = many.join(hot, key, "left").withColumn("_part", part).drop("_parts")
    copies = one.join(hot, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return dealt.join(copies, [key, "_part"]).drop("_part")


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, without a copy: what Python makes of a batch of texts is several times its size."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


_held: dict[Any, Any] = {}


def worker_held(key: Any, make: Callable[[], Any]) -> Any:
    """What make() gives, kept in this Python worker until another key is asked for.

    Workers outlive stages; what one operator has learnt doesn't weigh on the next.
    """
    if key not in _held:
        _held.clear()
        pa.default_memory_pool().release_unused()
        _held[key] = make()
    return _held[key]


def fold(doc_id: Column) -> Column:
    """crc32 of the id's decimal text, modulo 3; rows of fold 1 are held out of all fitting."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def held_out(doc_id: Column) -> Column:
    """True for rows of fold 1; a null id counts as not held out."""
    return F.coalesce(fold(doc_id) == 1, F.lit(False))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
