"""Runs, offsets, padding, splits and folds over events, documents, orders and lineitem."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memloom.functions import text
from memloom.operators import packing, routing, sequences, splits


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return sequences.run_ids(events, "user_id", "event_id", "event_type")


def run_length_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs(spark, sf_dir).select("event_id", "run")


def rle_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.run_counts(runs(spark, sf_dir), "user_id", "event_type")


def rank_in_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.rank_in_run(runs(spark, sf_dir), "user_id", "event_id").select("event_id", "rank")


def chunks_per_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of at most two events of one run, summed over a user's runs."""
    counted = sequences.run_counts(runs(spark, sf_dir), "user_id", "event_type")
    return counted.groupBy("user_id").agg(F.sum(F.ceil(F.col("n") / 2)).cast("long").alias("n_chunks"))


def exclusive_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars").withColumn("block", F.floor(F.col("doc_id") / 1024))
    return sequences.exclusive_offsets(docs, "block", "doc_id", "n_chars").select("doc_id", "offset")


def global_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's number and the characters before it, over the whole table."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("size"))
    return sequences.global_offsets(docs, "doc_id", "size").select("doc_id", "number", "offset")


def next_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line with the largest price of each order, as a token with the largest logit."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("token"), F.col("l_extendedprice").alias("logit"))
    return routing.next_token(lines, "l_orderkey", "token", "logit")


def sampled_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line of each order, drawn by its price."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("token"), (F.col("l_extendedprice") / 10000).alias("logit"))
    return routing.sampled_token(lines, "l_orderkey", "token", "logit", 0.7, 7)


def stable_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with even values first."""
    moved = sequences.stable_partition(F.col("ids"), F.transform("ids", lambda x: x % 2))
    return turns(spark, sf_dir).select("conv_id", "turn", listed(moved).alias("moved"))


def bucket_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's place when the buckets follow each other."""
    return packing.balanced_buckets(sized(spark, sf_dir), ["id"], "size", 4, place="place").select("id", "bucket", "place")


def local_to_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest document of each shard, found by its number in the shard, under its own id."""
    docs = table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 1024).alias("shard"), "doc_id", F.length("text").alias("n"))
    known = sequences.local_ids(docs, "shard", "doc_id")
    best = known.groupBy("shard").agg(F.max(F.struct("n", "local"))["local"].alias("local"))
    return sequences.global_ids(best, known.drop("n"), "shard")


def training_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns shuffled, packed to 256 tokens, padded and split between two ranks."""
    rows = turns(spark, sf_dir).select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("ids").alias("input_ids"), F.col("ids").alias("labels"))
    shares = packing.training_shares(rows, "id", 7, 256, 0, 2, "zigzag-ring")
    return shares.select("bag", "rank", *[listed(F.col(c)).alias(c) for c in ("input_ids", "labels", "attention_mask", "position_ids")])


def packed_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns packed to 256 tokens; a rank's share of each column."""
    rows = turns(spark, sf_dir).select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("ids").alias("input_ids"), F.col("ids").alias("labels"))
    packed = packing.split_columns(packing.packed_examples(rows, "id", 256, 0), 2, 0, "zigzag-ring")
    return packed.select("bag", *[listed(F.col(c)).alias(c) for c in ("input_ids", "labels", "attention_mask", "position_ids")])


def offset_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers of an order's parts, made to go on over a customer's orders."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = lines.select("o_custkey", "o_orderkey", F.col("l_linenumber").cast("long").alias("local"))
    joined = sequences.offset_concat(rows, "o_custkey", "o_orderkey", "local")
    return joined.groupBy("o_custkey").agg(F.max("joined").alias("last"), F.sum("joined").alias("total"))


def lengths(words: Column) -> Column:
    return F.transform(words, lambda w: F.length(w).cast("long"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", lengths(text.tokens(F.col("text"))).alias("ids"))


def listed(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda x: x.cast("string")), ",")


def left_pad_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = sequences.left_pad(turns(spark, sf_dir), "conv_id", "ids", 0)
    return padded.select("conv_id", "turn", listed(F.col("padded")).alias("padded"), listed(F.col("mask")).alias("mask"))


def left_pad_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as requests, four to a batch in the order of conversations, padded with roles and positions."""
    numbered = sequences.sub_batches(sequences.ordinals(turns(spark, sf_dir), "conv_id", "turn", name="number"), "number", 4)
    rows = numbered.withColumns({"roles": F.transform("ids", lambda _, i: (-(i % 3)).cast("long")), "places": F.transform("ids", lambda _, i: (i + 19).cast("long"))})
    padded = sequences.left_pad(rows, "batch", "ids", 7, "roles", "places")
    return padded.select("conv_id", "turn", "batch", *[listed(F.col(c)).alias(c) for c in ("padded", "mask", "padded_roles", "padded_positions")])


def length_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples shorter than cutoff - 1; longer ones are dropped as the operator's feature."""
    return turns(spark, sf_dir).where(F.size("ids") < 63).select("conv_id", "turn", F.size("ids").cast("long").alias("n"))


def label_shift_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = turns(spark, sf_dir).where(F.size("ids") < 63)
    return kept.select("conv_id", "turn", listed(sequences.shift_labels(F.col("ids"), 64)).alias("labels"))


def split_query(kind: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = turns(spark, sf_dir)
        shares = [listed(sequences.sequence_split(F.col("ids"), 2, r, kind)).alias(f"rank{r}") for r in range(2)]
        return rows.select("conv_id", "turn", *shares)

    return query


def sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents: their lines are chunks."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.count("*").alias("size"))


def balanced_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.balanced_buckets(sized(spark, sf_dir), ["id"], "size", 4).select("id", "bucket")


def bincount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items, first position and distinct parts of each order."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.min("l_linenumber").cast("long").alias("first"), F.countDistinct("l_partkey").alias("n_parts"))


def length_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs documents with benchmark items of equal word count, the k-th with the k-th, later items first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text.token_count(F.col("text")).alias("n"))
    items = table(spark, sf_dir, "benchmark").select("item_id", text.token_count(F.col("text")).alias("n"))
    d = sequences.ranked(docs, "n", "doc_id", name="k")
    i = sequences.ranked(items, "n", F.desc("item_id"), name="k")
    return i.join(d, ["n", "k"]).select("item_id", "doc_id", "n")


QUERIES = {f.__name__: f for f in (run_length_ids, rle_counts, rank_in_run, chunks_per_sample, exclusive_offsets, global_offsets, next_token, sampled_token, stable_partition, balanced_buckets, bucket_concat, local_to_global, training_shares, packed_examples, offset_concat, left_pad_batch, left_pad_requests, length_filter, label_shift_pad, bincount, length_pairing)} | {
    "sp_zigzag": split_query("zigzag-ring"),
    "sp_ulysses": split_query("ulysses"),
    "split_blocks": lambda spark, sf_dir: splits.split(sized(spark, sf_dir), splits.Blocks(24), ["id"], "size", "block").select("id", "block"),
    "split_slices": lambda spark, sf_dir: splits.split(sized(spark, sf_dir), splits.Slices(40), ["id"], "size", "slice", tail=16).select("id", "slice"),
    "knapsack_pack": lambda spark, sf_dir: packing.knapsack(sized(spark, sf_dir), "id", "size", 12).select("id", "bag"),
}
RUNS = """
    runs AS (
        SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS run
        FROM (SELECT user_id, event_id, event_type,
                     CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS new
              FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
    )"""
COUNTED = f"WITH {RUNS}, counted AS (SELECT user_id, run, any_value(event_type) AS event_type, count(*)::BIGINT AS n FROM runs GROUP BY user_id, run)"
TURNS = r"turns AS (SELECT conv_id, turn, list_transform(regexp_extract_all(text, '\S+'), lambda x: length(x)) AS ids FROM conversations)"
ITEMS = """
    items AS (SELECT l_orderkey AS id, count(*)::BIGINT AS size, row_number() OVER (ORDER BY l_orderkey) AS i FROM lineitem GROUP BY l_orderkey)"""
#: i: place by id; p, q: sums of sizes before and up to it.
SUMS = """
    sums AS (SELECT *, q - size AS p FROM (
        SELECT id, size, row_number() OVER (ORDER BY id) AS i, sum(size) OVER (ORDER BY id)::BIGINT AS q
        FROM (SELECT l_orderkey AS id, count(*)::BIGINT AS size FROM lineitem GROUP BY l_orderkey)))"""
SHARE = "array_to_string(ids[{a} * s + 1:{b} * s], ',')"


def zigzag(rank: int) -> str:
    first, second = (f"ids[{k} * s + 1:{k + 1} * s]" for k in (rank, 3 - rank))
    return f"array_to_string(list_concat({first}, {second}), ',') AS rank{rank}"


ORACLE_SQL = {
    "run_length_ids": f"WITH {RUNS} SELECT event_id, run FROM runs",
    "rle_counts": f"{COUNTED} SELECT user_id, run, event_type, n FROM counted",
    "rank_in_run": f"WITH {RUNS} SELECT event_id, row_number() OVER (PARTITION BY user_id, run ORDER BY event_id) - 1 AS rank FROM runs",
    "chunks_per_sample": f"{COUNTED} SELECT user_id, sum((n + 1) // 2)::BIGINT AS n_chunks FROM counted GROUP BY user_id",
    "exclusive_offsets": """
        SELECT doc_id, coalesce(sum(n_chars) OVER (PARTITION BY doc_id // 1024 ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
        FROM documents""",
    "global_offsets": """
        SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS number,
               coalesce(sum(length(text)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM documents""",
    "next_token": "SELECT l_orderkey, arg_max(l_linenumber, (l_extendedprice, -l_linenumber))::BIGINT AS token FROM lineitem GROUP BY l_orderkey",
    "sampled_token": """
        WITH u AS (SELECT l_orderkey, l_linenumber AS token, l_extendedprice / 10000 AS logit, (('0x' || substr(md5('7:' || l_orderkey || ':' || l_linenumber), 1, 13))::BIGINT + 0.5::DOUBLE) / pow(2.0::DOUBLE, 52) AS u FROM lineitem)
        SELECT l_orderkey, arg_max(token, (logit / 0.7::DOUBLE - ln(-ln(u)), -token))::BIGINT AS token FROM u GROUP BY l_orderkey""",
    "stable_partition": f"WITH {TURNS} SELECT conv_id, turn, array_to_string(list_concat(list_filter(ids, lambda x: x % 2 = 0), list_filter(ids, lambda x: x % 2 = 1)), ',') AS moved FROM turns",
    "local_to_global": """
        WITH d AS (SELECT doc_id // 1024 AS shard, doc_id, length(text) AS n, row_number() OVER (PARTITION BY doc_id // 1024 ORDER BY doc_id) - 1 AS local FROM documents)
        SELECT shard, arg_max(local, (n, local)) AS local, arg_max(doc_id, (n, local)) AS doc_id FROM d GROUP BY shard""",
    "offset_concat": """
        WITH parts AS (SELECT o_custkey, o_orderkey, max(l_linenumber) AS size FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL),
        based AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM parts)
        SELECT o_custkey, max(l_linenumber + base)::BIGINT AS last, sum(l_linenumber + base)::BIGINT AS total
        FROM based JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey""",
    "left_pad_batch": f"""
        WITH {TURNS}, sized AS (SELECT *, max(len(ids)) OVER (PARTITION BY conv_id) - len(ids) AS gap FROM turns)
        SELECT conv_id, turn, array_to_string(list_concat(list_transform(range(gap), lambda x: 0), ids), ',') AS padded,
               array_to_string(list_concat(list_transform(range(gap), lambda x: 0), list_transform(ids, lambda x: 1)), ',') AS mask FROM sized""",
    "left_pad_requests": f"""
        WITH {TURNS}, numbered AS (SELECT conv_id, turn, ids, (row_number() OVER (ORDER BY conv_id, turn) - 1) // 4 AS batch FROM turns),
        sized AS (SELECT *, range(max(len(ids)) OVER (PARTITION BY batch) - len(ids)) AS gap FROM numbered)
        SELECT conv_id, turn, batch::BIGINT AS batch, array_to_string(list_concat(list_transform(gap, lambda x: 7), ids), ',') AS padded,
               array_to_string(list_concat(list_transform(gap, lambda x: 0), list_transform(ids, lambda x: 1)), ',') AS mask,
               array_to_string(list_concat(list_transform(gap, lambda x: 0), list_transform(range(len(ids)), lambda i: -(i % 3))), ',') AS padded_roles,
               array_to_string(list_concat(list_transform(gap, lambda x: CASE WHEN len(ids) > 0 THEN 19 ELSE 0 END), list_transform(range(len(ids)), lambda i: i + 19)), ',') AS padded_positions FROM sized""",
    "length_filter": f"WITH {TURNS} SELECT conv_id, turn, len(ids)::BIGINT AS n FROM turns WHERE len(ids) < 63",
    "label_shift_pad": f"""
        WITH {TURNS} SELECT conv_id, turn, array_to_string(list_concat(ids[2:], list_transform(range(64 - len(ids[2:])), lambda x: -100)), ',') AS labels
        FROM turns WHERE len(ids) < 63""",
    "bincount": "SELECT l_orderkey, count(*)::BIGINT AS n, min(l_linenumber)::BIGINT AS first, count(DISTINCT l_partkey)::BIGINT AS n_parts FROM lineitem GROUP BY l_orderkey",
    "length_pairing": r"""
        WITH d AS (SELECT doc_id, len(regexp_extract_all(text, '\S+'))::BIGINT AS n FROM documents), i AS (SELECT item_id, len(regexp_extract_all(text, '\S+'))::BIGINT AS n FROM benchmark)
        SELECT item_id, doc_id, n FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY item_id DESC) AS k FROM i)
        JOIN (SELECT *, row_number() OVER (PARTITION BY n ORDER BY doc_id) AS k FROM d) USING (n, k)""",
    "sp_ulysses": f"WITH {TURNS} SELECT conv_id, turn, {SHARE.format(a=0, b=1)} AS rank0, {SHARE.format(a=1, b=2)} AS rank1 FROM (SELECT *, len(ids) // 2 AS s FROM turns)",
    "sp_zigzag": f"WITH {TURNS} SELECT conv_id, turn, {zigzag(0)}, {zigzag(1)} FROM (SELECT *, len(ids) // 4 AS s FROM turns)",
    "balanced_buckets": f"""
        WITH RECURSIVE {ITEMS}, f AS (
            SELECT id, i, 0 AS bucket, size AS a, 0::BIGINT AS b, 0::BIGINT AS c, 0::BIGINT AS d FROM items WHERE i = 1
            UNION ALL
            SELECT id, i, k, a + CASE k WHEN 0 THEN size ELSE 0 END, b + CASE k WHEN 1 THEN size ELSE 0 END, c + CASE k WHEN 2 THEN size ELSE 0 END, d + CASE k WHEN 3 THEN size ELSE 0 END
            FROM (SELECT n.id, n.i, n.size, a, b, c, d, CASE least(a, b, c, d) WHEN a THEN 0 WHEN b THEN 1 WHEN c THEN 2 ELSE 3 END AS k FROM f JOIN items n ON n.i = f.i + 1))
        SELECT id, bucket::BIGINT AS bucket FROM f""",
    "split_blocks": f"""
        WITH RECURSIVE {SUMS},
        nxt AS (SELECT i, i + greatest(count(*) OVER (ORDER BY q RANGE BETWEEN CURRENT ROW AND 24 - size FOLLOWING), 1) AS j FROM sums),
        f AS (SELECT 1::BIGINT AS i UNION ALL SELECT j FROM f JOIN nxt USING (i))
        SELECT id, count(f.i) OVER (ORDER BY sums.i) - 1 AS block FROM sums LEFT JOIN f USING (i)""",
    "split_slices": f"""
        WITH RECURSIVE {SUMS},
        nxt AS (SELECT i, i + 1 + count(*) OVER (ORDER BY q RANGE BETWEEN CURRENT ROW AND 39 - size FOLLOWING) AS j FROM sums),
        f AS (SELECT 1::BIGINT AS i UNION ALL SELECT j FROM f JOIN nxt USING (i)),
        named AS (SELECT id, size, count(f.i) OVER (ORDER BY sums.i) - 1 AS slice FROM sums LEFT JOIN f USING (i)),
        last AS (SELECT max(slice) AS most, arg_max(total, slice) AS total FROM (SELECT slice, sum(size) AS total FROM named GROUP BY slice))
        SELECT id, CASE WHEN total < 16 AND most > 0 THEN least(slice, most - 1) ELSE slice END AS slice FROM named, last""",
    "knapsack_pack": f"""
        WITH RECURSIVE items AS (SELECT l_orderkey AS id, count(*)::BIGINT AS size FROM lineitem GROUP BY l_orderkey),
        f AS (
            SELECT 0::BIGINT AS step, 0::BIGINT AS bag, 12 AS room, 0 AS got, {", ".join(f"(SELECT count(*) FROM items WHERE size = {k}) AS c{k}" for k in range(1, 13))}
            UNION ALL
            SELECT step + 1, CASE WHEN pick = 0 THEN bag + 1 ELSE bag END, CASE WHEN pick = 0 THEN 12 ELSE room - pick END, pick, {", ".join(f"c{k} - (pick = {k})::BIGINT" for k in range(1, 13))}
            FROM (SELECT *, CASE {" ".join(f"WHEN c{k} > 0 AND room >= {k} THEN {k}" for k in range(12, 0, -1))} ELSE 0 END AS pick FROM f)
            WHERE {" + ".join(f"c{k}" for k in range(1, 13))} > 0),
        dealt AS (SELECT bag, got AS size, row_number() OVER (PARTITION BY got ORDER BY step) AS k FROM f WHERE got > 0)
        SELECT id, coalesce(bag, -1) AS bag FROM (SELECT *, row_number() OVER (PARTITION BY size ORDER BY id DESC) AS k FROM items) LEFT JOIN dealt USING (size, k)""",
}
ORACLE_SQL["bucket_concat"] = f"SELECT id, bucket, row_number() OVER (ORDER BY bucket, id) - 1 AS place FROM ({ORACLE_SQL['balanced_buckets']})"
