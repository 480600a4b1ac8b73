"""Measures of retrieval, and losses over scored candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def set_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """precision, recall, f1, iou of two arrays as sets; all 0 if the truth is empty."""
    t, p = F.array_distinct(truth), F.array_distinct(predicted)
    hits, both = F.size(F.array_intersect(t, p)).cast("double"), F.size(F.array_union(t, p))
    ratio = lambda a, b: F.when((F.size(t) > 0) & (b > 0), a / b).otherwise(0.0)
    precision, recall = ratio(hits, F.size(p)), ratio(hits, F.size(t))
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    return df.withColumns({"precision": precision, "recall": recall, "f1": f1, "iou": ratio(hits, both)})


def first_hits(ranked: DataFrame, labels: DataFrame, queries: DataFrame) -> DataFrame:
    """query_id, first: the best rank of any label; null without one.  ranked: query_id, doc_id, rank."""
    hit = ranked.join(labels, ["query_id", "doc_id"]).groupBy("query_id").agg(F.min("rank").alias("first"))
    return queries.join(hit, "query_id", "left")


def hit_at(first: Column, k: int) -> Column:
    return F.avg(F.when(first <= k, 1.0).otherwise(0.0))


def mrr_at(first: Column, k: int) -> Column:
    return F.avg(F.when(first <= k, 1.0 / first).otherwise(0.0))


def router_recall(scored: DataFrame, n: int, most: int = 10) -> DataFrame:
    """sample, recall: positives among the n best over min(positives, most).  scored: sample, doc_id, score, y."""
    order = Window.partitionBy("sample").orderBy(F.desc("score"), "doc_id")
    ranked = scored.withColumn("_rank", F.row_number().over(order))
    total = F.sum("y")
    hits = F.sum(F.when(F.col("_rank") <= n, F.col("y")).otherwise(0))
    return ranked.groupBy("sample").agg(F.when(total > 0, hits / F.least(total, F.lit(most))).alias("recall")).where("recall is not null")


def _stable(scored: DataFrame, temperature: float) -> DataFrame:
    t = min(max(temperature, 0.001), 0.5)
    z = F.col("score") / t
    w = Window.partitionBy("sample")
    return scored.withColumn("_z", z - F.max(z).over(w)).withColumn("_e", F.exp("_z"))


def losses(scored: DataFrame, kind: str, temperature: float = 0.1, gamma: float = 2.0, bias: float = -20.0) -> DataFrame:
    """sample, loss.  scored: sample, score, y (0 or 1); samples without a positive are left out but for bce."""
    if kind == "bce":
        z = (F.col("score") + bias) * (2 * F.col("y") - 1)
        softplus = F.greatest(-z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
        return scored.groupBy("sample").agg(F.avg(softplus).alias("loss"))
    w = Window.partitionBy("sample")
    rows = _stable(scored, temperature)
    if kind in ("infonce", "focal"):
        rows = rows.withColumn("_p", F.col("_e") / F.sum("_e").over(w))
        logp = F.col("_z") - F.log(F.sum("_e").over(w))
    elif kind in ("decoupled", "multi_focal"):
        others = F.sum(F.col("_e") * (1 - F.col("y"))).over(w)
        rows = rows.withColumn("_p", F.col("_e") / (F.col("_e") + others + 1e-10))
        logp = F.log("_p")
    else:
        raise ValueError(f"unknown loss {kind!r}")
    term = -logp * F.col("y")
    if kind in ("focal", "multi_focal"):
        term = term * F.pow(1 - F.col("_p"), gamma)
    positives = F.sum("y")
    divisor = positives + 1e-6 if kind == "multi_focal" else positives
    summed = rows.withColumn("_t", term).groupBy("sample").agg(positives.alias("_n"), (F.sum("_t") / divisor).alias("loss"))
    return summed.where("_n > 0").drop("_n")


def layered_loss(scored: DataFrame, kind: str, first: int, layers: list[int], least: float = -1e9) -> DataFrame:
    """loss, n: the mean loss over layers and samples.  scored: layer, sample, score, y.

    Layers from `first` on that are among `layers` count, and candidates whose
    score is above `least`; a sample without any is left out.
    """
    kept = scored.where((F.col("layer") >= first) & F.col("layer").isin(layers) & (F.col("score") > least))
    own = kept.select(F.struct("layer", "sample").alias("sample"), "score", "y")
    return losses(own, kind).agg(F.avg("loss").alias("loss"), F.count("*").alias("n"))


def result_records(rows: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """rows (key, labels, predictions) with both lists' texts, and the measures.

    labels_text and predictions_text are null, so there is no record, if any
    cited id lacks a document; such a row's measures count all the same.
    """
    cites = rows.select(key, F.explode(F.array_distinct(F.concat("labels", "predictions"))).alias("doc_id"))
    found = cites.join(docs.select("doc_id", "text"), "doc_id").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("doc_id", "text"))).alias("_texts"))
    whole = F.forall(F.concat("labels", "predictions"), lambda i: F.exists("_texts", lambda x: x["doc_id"] == i))
    listed = lambda c: F.when(whole, F.transform(c, lambda i: F.get(F.filter("_texts", lambda x: x["doc_id"] == i), 0)["text"]))
    joined = rows.join(found, key, "left")
    joined = joined.withColumns({"labels_text": listed("labels"), "predictions_text": listed("predictions")}).drop("_texts")
    return set_metrics(joined, "labels", "predictions")


def weighted_total(parts: dict[str, float]) -> Column:
    return sum((F.col(c) * w for c, w in parts.items()), F.lit(0.0))
