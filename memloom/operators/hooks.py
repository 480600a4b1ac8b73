"""Where models come in: encoders, projections, decoders and judges as callables, taken in batches.

A callable is made once for each task, so that a model is loaded once; it gets
lists and gives a list of the same length.  The stand-ins here are deterministic
and show the flow of data, not a model's quality.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memloom.functions import text

MATRIX = "array<array<double>>"


def hook(make: Callable[[], Callable[..., list]], kind: str) -> Callable[..., Column]:
    """A function of columns whose values a callable gives, batch by batch; make is called in the task."""

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        call = make()
        for columns in batches:
            # One column comes as it is, several as a tuple.
            columns = (columns,) if isinstance(columns, pd.Series) else columns
            yield pd.Series(call(*[c.tolist() for c in columns]), dtype=object)

    return F.pandas_udf(run, kind)


def projection(weights: np.ndarray) -> Callable[[Column], Column]:
    """A linear map without bias, one matrix product a batch; rows of weights are outputs.  Null vectors stay null."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            known = column.is_valid().to_numpy(zero_copy_only=False)
            vectors = column.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(int(known.sum()), -1)
            out = vectors @ weights.T if len(vectors) else np.zeros(0)
            offsets = np.r_[0, np.cumsum(np.where(known, len(weights), 0))].astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()), mask=pa.array(~known))

    return F.arrow_udf(run, "array<double>")


def pooled(x: np.ndarray, pool: int) -> np.ndarray:
    """Means over up to `pool` rows."""
    starts = np.arange(0, len(x), pool)
    return np.add.reduceat(x, starts, axis=0) / np.diff(np.r_[starts, len(x)])[:, None]


def encoded(docs: DataFrame, make: Callable[[], Callable[[list[str]], tuple[np.ndarray, ...]]], pool: int) -> DataFrame:
    """doc_id, chunk, k, v, rk of every chunk.  docs: doc_id, tokens.

    The encoder sees one document's tokens at a time and gives keys, values and
    router keys, a row each token; they are pooled before they leave the task.
    A document without tokens has no chunk.
    """

    def pooling() -> Callable[[list], list]:
        encoder = make()

        def call(rows: list) -> list:
            return [None if t is None or not len(t) else np.stack([pooled(np.asarray(x, dtype=np.float64), pool) for x in encoder(list(t))], axis=1).tolist() for t in rows]

        return call

    chunks = hook(pooling, f"array<{MATRIX}>")(F.col("tokens"))
    rows = docs.select("doc_id", F.posexplode(chunks).alias("chunk", "x"))
    return rows.select("doc_id", F.col("chunk").cast("long").alias("chunk"), *[F.col("x")[i].alias(c) for i, c in enumerate(("k", "v", "rk"))])


def running_means() -> Callable[[list[str]], tuple[np.ndarray, ...]]:
    """A stand-in encoder: a token is its length and its first sign's code; keys are means over all tokens up to one, so nothing later is seen."""

    def call(tokens: list[str]) -> tuple[np.ndarray, ...]:
        x = np.array([(len(t), ord(t[0])) for t in tokens], dtype=np.float64)
        k = np.cumsum(x, axis=0) / np.arange(1, len(x) + 1)[:, None]
        return k, x, k[:, ::-1]

    return call


def decoded(ids: Column, make: Callable[[], Callable[[list], list[str]]]) -> Column:
    """Texts of arrays of token ids."""
    return hook(make, "string")(ids)


def scored(df: DataFrame, make: Callable[[], Callable[[str, str, str], str]], question: str, true: str, predicted: str) -> DataFrame:
    """df with reply and pred_score: a judge's reply to each row and the score in it; a judge that fails replies nothing, which scores 0."""

    def careful() -> Callable[..., list]:
        judge = make()

        def reply(*row: str) -> str:
            try:
                return judge(*row)
            except Exception:  # A judge outside may fail in any way; one reply's failure is that row's result.
                return ""

        return lambda *columns: [reply(*row) for row in zip(*columns)]

    replied = df.withColumn("reply", hook(careful, "string")(F.col(question), text.cleaned(F.col(true)), text.cleaned(F.col(predicted))))
    return replied.withColumn("pred_score", text.judged(F.col("reply")))


def overlap_judge() -> Callable[[str, str, str], str]:
    """A stand-in judge: five times the F1 of both answers' distinct words, rounded down."""

    def call(question: str, true: str, predicted: str) -> str:
        a, b = ({w for w in t.split(" ") if w} for t in (true, predicted))
        return f"Score: {10 * len(a & b) // max(1, len(a) + len(b))}"

    return call
