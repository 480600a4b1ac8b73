"""Vectors as array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: Column) -> Column:
    """Length one; a zero vector stays."""
    size = norm(v)
    return F.transform(v, lambda x: F.when(size > 0, x / size).otherwise(x))


def head(v: Column, number: int, width: int) -> Column:
    return F.slice(v, number * width + 1, width)
