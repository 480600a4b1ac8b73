"""Rounds of retrieval and generation: cite, inject the cited documents, ask again, answer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memloom.functions import text

Generator = Callable[[DataFrame], DataFrame]


def injected(state: DataFrame, docs: DataFrame, closing: Column) -> DataFrame:
    """prompt with what a round's end calls for.

    Documents that out cites, a line each in order of id, with an end marker;
    ids that the corpus lacks are dropped.  Where retrieval is closing, the
    question once more if out says so, else nothing.
    """
    cites = state.where(~closing).select("query_id", F.explode(text.cited_ids(F.col("out"))).alias("doc_id"))
    lines = docs.select("doc_id", F.concat(F.lit("["), F.col("doc_id").cast("string"), F.lit("]. "), "text", F.lit("\n")).alias("line"))
    listed = F.array_sort(F.collect_list(F.struct("doc_id", "line")))
    found = cites.join(lines, "doc_id").groupBy("query_id").agg(F.array_join(F.transform(listed, lambda x: x["line"]), "").alias("context"))
    ended = F.when(F.col("out").contains(text.RETRIEVE_END), text.question_again(F.col("question"))).otherwise("")
    more = F.when(closing, ended).otherwise(F.concat(F.coalesce("context", F.lit("")), F.lit(text.OBJECT_END)))
    return state.join(found, "query_id", "left").withColumn("prompt", F.concat("prompt", F.lit(text.REGENERATE), "out", more))


def interleave(queries: DataFrame, docs: DataFrame, generate: Generator, folder: str, most: int = 8) -> DataFrame:
    """query_id, rounds, out.  queries: query_id, prompt; generate adds out to query_id, prompt.

    A query goes on while its rounds end in citations.  Once retrieval is over,
    because out says so, a first round is too long or a later one says more than
    an id, one last round follows.  Each round's state is a table in the shared
    folder, so plans stay short and survive lost executors.  After `most` rounds
    a query keeps what it has.
    """
    spark = queries.sparkSession
    state = queries.select("query_id", "prompt", text.question_of(F.col("prompt")).alias("question"), F.lit(False).alias("last"))
    done: DataFrame | None = None
    for number in range(1, most + 1):
        generate(state).select("query_id", "prompt", "question", "last", "out").write.mode("overwrite").parquet(f"{folder}/round={number}")
        state = spark.read.parquet(f"{folder}/round={number}")
        out = F.col("out")
        wants = text.must_regenerate(out) | (out.contains(text.RETRIEVE_END) & ~out.contains(text.ANSWER))
        again = F.coalesce(wants & ~F.col("last"), F.lit(False)) if number < most else F.lit(False)
        over = state.where(~again).select("query_id", F.lit(number).cast("long").alias("rounds"), "out")
        done = over if done is None else done.unionByName(over)
        state = state.where(again)
        if state.isEmpty():
            break
        closing = text.retrieval_over(out, F.lit(number == 1))
        state = injected(state, docs, closing).select("query_id", "prompt", "question", closing.alias("last"))
    return done
