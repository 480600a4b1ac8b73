"""Corpora as relations: ids of labels by their texts, distractor copies, gathered recall lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memloom.operators.sequences import ordinals


def ids_of(labels: DataFrame, docs: DataFrame, label: str = "label", name: str = "doc_id") -> DataFrame:
    """labels with the id of the document that has just this text, the largest of several; null if none has.

    Texts are compared by a digest, so that neither is shuffled.
    """
    digest = F.sha2(F.col("text"), 256).alias("_digest")
    known = docs.select(digest, F.col("doc_id").alias("_id")).groupBy("_digest").agg(F.max("_id").alias("_id"))
    asked = labels.withColumn("_digest", F.sha2(F.col(label), 256))
    return asked.join(known, "_digest", "left").select(*labels.columns, F.col("_id").alias(name))


def scaled(docs: DataFrame, labels: DataFrame, scale: int) -> DataFrame:
    """doc_id, text: the corpus in the order of its ids, then `scale` rounds of copies of all texts that aren't labels (text).

    Documents are numbered from 0; a copy's text names its place in the rounds,
    those of labels' texts counted too, and copies are numbered on in this order.
    """
    digest = F.sha2(F.col("text"), 256)
    corpus = ordinals(docs.select("doc_id", "text"), "doc_id", name="_place").withColumn("_digest", digest)
    n = corpus.count()
    free = corpus.join(labels.select(digest.alias("_digest")).distinct(), "_digest", "left_anti")
    # Where copies stand among each other is told by places alone, without texts.
    kept = ordinals(free.select("_place"), "_place", name="_k")
    m = kept.count()
    rounds = free.join(kept, "_place").withColumn("_round", F.explode(F.sequence(F.lit(0), F.lit(scale - 1)))) if scale > 0 else free.limit(0).selectExpr("*", "0L AS _k", "0 AS _round")
    copy = F.concat("text", F.lit("_copy"), (F.col("_round") * F.lit(n) + F.col("_place")).cast("string"))
    copies = rounds.select((F.lit(n) + F.col("_round") * F.lit(m) + F.col("_k")).cast("long").alias("doc_id"), copy.alias("text"))
    return corpus.select(F.col("_place").cast("long").alias("doc_id"), "text").unionByName(copies)


def recall_lists(found: DataFrame) -> DataFrame:
    """request, layer, lists: the ids that a request's responses found in a layer, a list each, in the order of seq."""
    held = F.array_sort(F.collect_list(F.struct("seq", "ids")))
    return found.groupBy("request", "layer").agg(F.transform(held, lambda x: x["ids"]).alias("lists"))
