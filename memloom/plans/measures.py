"""Retrieval measures over orders (what was returned against what is open) and losses over labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from memloom.operators import metrics


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's true parts (returned or accepted) and predicted parts (open)."""
    part = lambda flag: F.collect_list(F.when(flag, F.col("l_partkey")))
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy("l_orderkey").agg(part(F.col("l_returnflag") != "N").alias("truth"), part(F.col("l_linenumber") % 2 == 1).alias("predicted"))


NAMES = ("precision", "recall", "f1", "iou")


def set_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = metrics.set_metrics(sets(spark, sf_dir), "truth", "predicted")
    return scored.select("l_orderkey", *[F.round(c, 6).alias(c) for c in NAMES])


def macro_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = metrics.set_metrics(sets(spark, sf_dir), "truth", "predicted")
    return scored.agg(*[F.round(F.avg(c), 4).alias(c) for c in NAMES])


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders rank their lines by price; labels are the lines that were returned."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("query_id"), F.col("l_partkey").alias("doc_id"), "l_extendedprice", "l_returnflag")
    w = Window.partitionBy("query_id").orderBy(F.desc("l_extendedprice"), "doc_id")
    ranked = lines.groupBy("query_id", "doc_id").agg(F.max("l_extendedprice").alias("l_extendedprice")).withColumn("rank", F.row_number().over(w))
    labels = lines.where("l_returnflag = 'R'").select("query_id", "doc_id").distinct()
    return metrics.first_hits(ranked, labels, lines.select("query_id").distinct())


def hit_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.col("first")
    return hits(spark, sf_dir).agg(*[F.round(metrics.hit_at(first, k), 6).alias(f"r{k}") for k in (1, 5, 10)])


def mrr_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.col("first")
    return hits(spark, sf_dir).agg(*[F.round(metrics.mrr_at(first, k), 6).alias(f"mrr{k}") for k in (1, 10)])


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of 40 documents; y is quality, the score a fixed function of the id."""
    rows = table(spark, sf_dir, "labels").where("quality is not null")
    return rows.select(F.floor(F.col("doc_id") / 40).cast("long").alias("sample"), "doc_id", ((F.col("doc_id") * 37 % 101) / 202.0 - 0.2).alias("score"), F.col("quality").alias("y"))


def router_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [metrics.router_recall(scored(spark, sf_dir), n).withColumn("n", F.lit(n).cast("long")) for n in (1, 5, 10)]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.groupBy("n").agg(F.round(F.avg("recall"), 6).alias("recall"))


def loss_query(kind: str):
    return lambda spark, sf_dir: metrics.losses(scored(spark, sf_dir), kind).select("sample", F.round("loss", 6).alias("loss"))


def total_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean of two losses over samples, weighted."""
    parts = [metrics.losses(scored(spark, sf_dir), k).withColumnRenamed("loss", k) for k in ("infonce", "bce")]
    means = parts[0].join(parts[1], "sample").agg(F.avg("infonce").alias("infonce"), F.avg("bce").alias("bce"))
    return means.select(F.round(metrics.weighted_total({"infonce": 1.0, "bce": 0.1}), 5).alias("loss"))


def aux_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean loss over the upper two of four layers, whose scores differ; the last has documents without a score."""
    layer = F.explode(F.sequence(F.lit(0), F.lit(3)))
    rows = scored(spark, sf_dir).withColumn("layer", layer)
    gone = (F.col("doc_id") % 7 == 0) & (F.col("layer") == 3)
    rows = rows.withColumn("score", F.when(gone, F.lit(float("-inf"))).otherwise(F.col("score") * (1 + F.col("layer") / 4)))
    return metrics.layered_loss(rows, "infonce", 2, [1, 2, 3]).select(F.round("loss", 5).alias("loss"), "n")


KINDS = ("infonce", "decoupled", "focal", "multi_focal", "bce")
QUERIES = {f.__name__: f for f in (set_metrics, macro_metrics, hit_at_k, mrr_at_k, router_recall, total_loss, aux_loss)} | {f"loss_{k}": loss_query(k) for k in KINDS}
SETS = """
    WITH s AS (SELECT l_orderkey, coalesce(list_distinct(list(l_partkey) FILTER (WHERE l_returnflag <> 'N')), []) AS t,
                      coalesce(list_distinct(list(l_partkey) FILTER (WHERE l_linenumber % 2 = 1)), []) AS p FROM lineitem GROUP BY l_orderkey),
    c AS (SELECT l_orderkey, len(list_intersect(t, p))::DOUBLE AS h, len(t) AS nt, len(p) AS np FROM s),
    m AS (SELECT l_orderkey, CASE WHEN nt > 0 AND np > 0 THEN h / np ELSE 0 END AS precision, CASE WHEN nt > 0 THEN h / nt ELSE 0 END AS recall,
                 CASE WHEN nt > 0 THEN h / (nt + np - h) ELSE 0 END AS iou FROM c),
    f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM m)"""
HITS = """
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY p DESC, l_partkey) AS rank
               FROM (SELECT l_orderkey, l_partkey, max(l_extendedprice) AS p, bool_or(l_returnflag = 'R') AS label FROM lineitem GROUP BY ALL)),
    h AS (SELECT l_orderkey, min(rank) FILTER (WHERE label) AS first FROM r GROUP BY l_orderkey)"""
SCORED = "WITH s AS (SELECT doc_id // 40 AS sample, doc_id, (doc_id * 37 % 101) / 202.0::DOUBLE - 0.2::DOUBLE AS score, quality AS y FROM labels WHERE quality IS NOT NULL)"
EXPS = SCORED + """, z AS (SELECT *, score / 0.1::DOUBLE - max(score / 0.1::DOUBLE) OVER (PARTITION BY sample) AS z FROM s),
    e AS (SELECT *, exp(z) AS e, sum(exp(z)) OVER (PARTITION BY sample) AS every, sum(exp(z) * (1 - y)) OVER (PARTITION BY sample) AS others FROM z)"""


def loss_sql(kind: str) -> str:
    if kind == "bce":
        return SCORED + "SELECT sample, round(avg(greatest(-x, 0) + ln(1 + exp(-abs(x)))), 6) AS loss FROM (SELECT sample, (score - 20) * (2 * y - 1) AS x FROM s) GROUP BY sample"
    decoupled = kind in ("decoupled", "multi_focal")
    p = "e / (e + others + 1e-10)" if decoupled else "e / every"
    logp = f"ln({p})" if decoupled else "(z - ln(every))"
    weight = f" * pow(1 - {p}, 2)" if "focal" in kind else ""
    return f"{EXPS} SELECT sample, round(sum(-{logp} * y{weight}) / (sum(y){' + 1e-6' if kind == 'multi_focal' else ''}), 6) AS loss FROM e GROUP BY sample HAVING sum(y) > 0"


ORACLE_SQL = {
    "set_metrics": SETS + " SELECT l_orderkey, " + ", ".join(f"round({c}, 6) AS {c}" for c in NAMES) + " FROM f",
    "macro_metrics": SETS + " SELECT " + ", ".join(f"round(avg({c}), 4) AS {c}" for c in NAMES) + " FROM f",
    "hit_at_k": HITS + " SELECT " + ", ".join(f"round(avg(CASE WHEN first <= {k} THEN 1.0::DOUBLE ELSE 0 END), 6) AS r{k}" for k in (1, 5, 10)) + " FROM h",
    "mrr_at_k": HITS + " SELECT " + ", ".join(f"round(avg(CASE WHEN first <= {k} THEN 1.0::DOUBLE / first ELSE 0 END), 6) AS mrr{k}" for k in (1, 10)) + " FROM h",
    "router_recall": SCORED + """, r AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY score DESC, doc_id) AS rank FROM s),
        g AS (SELECT n, sample, sum(y) FILTER (WHERE rank <= n)::DOUBLE / least(sum(y), 10) AS recall FROM r, (SELECT unnest([1, 5, 10])::BIGINT AS n) GROUP BY n, sample HAVING sum(y) > 0)
        SELECT n, round(avg(recall), 6) AS recall FROM g GROUP BY n""",
    "aux_loss": """
        WITH s AS (SELECT doc_id // 40 AS sample, l AS layer, ((doc_id * 37 % 101) / 202.0::DOUBLE - 0.2::DOUBLE) * (1 + l / 4.0::DOUBLE) / 0.1::DOUBLE AS z, quality AS y
                   FROM labels, range(2, 4) r(l) WHERE quality IS NOT NULL AND NOT (doc_id % 7 = 0 AND l = 3)),
        e AS (SELECT *, ln(sum(exp(z)) OVER (PARTITION BY layer, sample)) AS t FROM s),
        o AS (SELECT layer, sample, sum((t - z) * y) / sum(y) AS loss FROM e GROUP BY layer, sample HAVING sum(y) > 0)
        SELECT round(avg(loss), 5) AS loss, count(*)::BIGINT AS n FROM o""",
    "total_loss": f"SELECT round(avg(a.loss) + 0.1 * avg(b.loss), 5) AS loss FROM ({loss_sql('infonce').replace('6) AS loss', '15) AS loss')}) a JOIN ({loss_sql('bce').replace('6) AS loss', '15) AS loss')}) b USING (sample)",
} | {f"loss_{k}": loss_sql(k) for k in KINDS}
