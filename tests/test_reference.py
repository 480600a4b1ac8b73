"""Operators against their SQL, plain Python and worked examples."""

import json
import os
import random
import shutil
import subprocess
import sys
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from memloom.config import MemoryConfig, read_config
from memloom.functions import text
from memloom.operators import corpora, hooks, interleave, metrics, packing, prompts, readout, routing, sequences, splits
from memloom.plans import ORACLE_SQL, QUERIES
from memloom.plans import routing as plans
from memloom.sources import registry, snapshots
from memloom.streaming import requests

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLE_SQL[name])
    names = sorted(got.columns)
    assert sorted(want.columns) == names
    at = [want.columns.index(c) for c in names]
    rows = sorted((tuple(plain(r[c]) for c in names) for r in got.collect()), key=repr)
    assert rows == sorted((tuple(plain(r[k]) for k in at) for r in want.fetchall()), key=repr)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def plain_blocks(sizes, cap):
    out, block, total = [], 0, 0
    for k, size in enumerate(sizes):
        if k and total + size > cap:
            block, total = block + 1, 0
        total += size
        out.append(block)
    return out


def plain_slices(sizes, threshold, tail):
    out, number, total = [], 0, 0
    for size in sizes:
        total += size
        out.append(number)
        if total >= threshold:
            number, total = number + 1, 0
    return [min(x, number - 1) for x in out] if 0 < total < tail and number else out


def plain_bags(sizes, capacity):
    left, out, bag = sorted((s, k) for k, s in enumerate(sizes) if s <= capacity), [-1] * len(sizes), 0
    while left:
        room = capacity
        while fitting := [x for x in left if x[0] <= room]:
            s, k = fitting[-1]
            left.remove((s, k))
            out[k], room = bag, room - s
        bag += 1
    return out


def test_worked_folds(spark):
    assert packing.balanced([5, 3, 4, 1, 2], 2) == [0, 1, 1, 0, 0]
    assert plain_blocks([5, 3, 4, 1, 2], 6) == [0, 1, 2, 2, 3] and plain_blocks([9, 1], 6) == [0, 1]
    assert plain_slices([5, 3, 4, 1, 2], 6, 6) == [0, 0, 1, 1, 1] and plain_slices([5, 3, 4, 1], 6, 6) == [0, 0, 0, 0] and plain_slices([2, 1], 6, 6) == [0, 0]
    sizes = [7, 5, 4, 3, 2]
    bags = plain_bags(sizes, 10)
    assert [sorted((s for s, b in zip(sizes, bags) if b == k), reverse=True) for k in range(3)] == [[7, 3], [5, 4], [2]]


@pytest.mark.parametrize("seed", range(40))
def test_tables_of_ranges_compose(seed):
    """Every way to cut the rows into ranges and enter them in the state that the one before is left in gives the plain fold."""
    rng = random.Random(seed)
    sizes = [rng.choice([0, 0, 1, 2, 3, rng.randrange(30)]) for _ in range(rng.randrange(1, 60))]
    cap = rng.randrange(1, 20)
    for splitter, want in ((splits.Blocks(cap), plain_blocks(sizes, cap)), (splits.Slices(cap), plain_slices(sizes, cap, 0))):
        state, before, got, at = splitter.start, 0, [], 0
        while at < len(sizes):
            part = np.array(sizes[at : at + rng.randrange(1, 12)])
            got += splitter.numbers(part, state, before).tolist()
            out, closed = splitter.table(part)
            assert len(out) == len(closed) == (cap + 3 if isinstance(splitter, splits.Blocks) else cap)
            state, before, at = int(out[state]), before + int(closed[state]), at + len(part)
        assert got == want


@pytest.mark.parametrize("width,fan", [(7, 3), (64, 2), (1 << 16, 128)])
def test_splits_of_a_whole_table(spark, width, fan):
    rng = random.Random(width)
    sizes = [rng.choice([None, 0, 1, 2, 5, 9, 40]) for _ in range(500)]
    rows = [(k * 3 - 200, s, "x") for k, s in enumerate(sizes)]
    table = spark.createDataFrame(rows, "id long, size int, _number string").repartition(5)
    plain = [s or 0 for s in sizes]
    for splitter, tail, want in ((splits.Blocks(11), 0, plain_blocks(plain, 11)), (splits.Slices(23), 0, plain_slices(plain, 23, 0)), (splits.Slices(23), 23, plain_slices(plain, 23, 23))):
        got = splits.split(table, splitter, ["id"], "size", "part", width=width, fan=fan, tail=tail)
        assert got.columns == ["id", "size", "_number", "part"]
        assert [r.part for r in got.orderBy("id").collect()] == want
    assert splits.split(table.limit(0), splits.Blocks(5), ["id"], "size", "part").collect() == []


@pytest.mark.parametrize("largest,buckets,width", [(4, 4, 16), (4, 8, 64), (900, 3, 50), (0, 2, 16), (7, 4, 1 << 16)])
def test_balanced_buckets_of_a_whole_table(spark, largest, buckets, width):
    """Ranges that guess how full buckets are agree with one fold in the end; sizes that hardly tie go through all ranges, and are right too."""
    rng = random.Random(largest)
    sizes = [rng.randrange(largest + 1) if rng.random() < 0.9 else None for _ in range(300)]
    rows = spark.createDataFrame([(k % 7, k, s, -1) for k, s in enumerate(sizes)], "_cell long, _number long, size long, bucket long")
    order = sorted(range(300), key=lambda k: (k % 7, -k))
    want = dict(zip(order, packing.balanced([sizes[k] or 0 for k in order], buckets)))
    got = packing.balanced_buckets(rows, ["_cell", F.desc("_number")], "size", buckets, width=width)
    assert sorted(got.columns) == sorted(rows.columns)
    assert {r["_number"]: (r["_cell"], r["size"], r["bucket"]) for r in got.collect()} == {k: (k % 7, sizes[k], want[k]) for k in range(300)}
    assert packing.balanced_buckets(rows.limit(0), ["_number"], "size", buckets).count() == 0


@pytest.mark.parametrize("largest,width", [(7, 100), (900, 50)])
def test_places_in_buckets(spark, monkeypatch, largest, width):
    """Buckets follow each other, each in the given order, without another sort of all items; also where ranges are folded again."""
    rng = random.Random(largest)
    rows = [(k, rng.randrange(largest + 1), "x") for k in range(400)]
    want = packing.balanced([r[1] for r in reversed(rows)], 3)
    sorts, sort = [], packing.ordinals
    monkeypatch.setattr(packing, "ordinals", lambda *a, **k: sorts.append(a) or sort(*a, **k))
    table = spark.createDataFrame(rows, "id long, size long, place string").repartition(5)
    got = packing.balanced_buckets(table, [F.desc("id")], "size", 3, width=width, place="place").sort("place").collect()
    assert [(r.bucket, r.place, r.id) for r in got] == [(b, n, 399 - k) for n, (b, k) in enumerate(sorted((b, k) for k, b in enumerate(want)))]
    assert len(sorts) == 1


@pytest.mark.parametrize("unit,buckets", [(1, 4), (24, 3)])
def test_ranges_of_buckets_are_guessed(spark, monkeypatch, unit, buckets):
    """Where sizes tie now and then, every range is entered as guessed, whatever the sizes before it add up to: nothing is folded again."""
    rng = random.Random(unit)
    sizes = [unit * rng.randrange(1, 8) for _ in range(8000)]
    tags, write = [], packing.written
    monkeypatch.setattr(packing, "written", lambda df, tag: tags.append(tag) or write(df, tag))
    got = packing.balanced_buckets(spark.createDataFrame(list(enumerate(sizes)), "id long, size long"), ["id"], "size", buckets, width=1000)
    assert [r.bucket for r in got.sort("id").collect()] == packing.balanced(sizes, buckets)
    assert tags.count("wrong") == 1


def test_templates_equal_plain_packing():
    rng = random.Random(1)
    for _ in range(300):
        capacity = rng.randint(1, 20)
        sizes = [rng.choice([0, 1, rng.randint(0, 25)]) for _ in range(rng.randint(0, 40))]
        counts = {s: sizes.count(s) for s in set(sizes)}
        want = plain_bags(sizes, capacity)
        held = {}
        for s, b in zip(sizes, want):
            if b >= 0:
                held.setdefault(b, {}).setdefault(s, 0)
                held[b][s] += 1
        got = {}
        for first, times, uses in packing.templates(counts, capacity):
            for b in range(first, first + times):
                got[b] = uses
        assert got == held


def test_knapsack_of_a_whole_table(spark):
    """A third of the items has one size; some are empty, too large or of no size."""
    rng = random.Random(4)
    sizes = [4 if k % 3 == 0 else rng.choice([0, 1, 2, 3, 7, 11, 12, 13, 40]) for k in range(400)]
    table = spark.createDataFrame([(k, s, "x") for k, s in enumerate(sizes)], "id long, size int, _number string").repartition(4)
    got = packing.knapsack(table, "id", "size", 12)
    assert got.columns == ["id", "size", "_number", "bag"]
    assert [r.bag for r in got.orderBy("id").collect()] == plain_bags(sizes, 12)
    unknown = spark.createDataFrame([(1, None), (2, 3)], "id long, size int")
    assert sorted((r.id, r.bag) for r in packing.knapsack(unknown, "id", "size", 12).collect()) == [(1, -1), (2, 0)]
    assert packing.knapsack(table.limit(0), "id", "size", 12).collect() == []


def one(spark, **columns):
    return spark.createDataFrame([tuple(columns.values())], list(columns))


def test_worked_text(spark):
    row = one(spark, t="[12]. foo[3] [x] [12]", judge="9 then 3").select(text.cited_ids(F.col("t")).alias("ids"), text.judged(F.col("judge")).alias("j"))
    assert row.first() == ([3, 12], 3)
    counts = spark.createDataFrame([(1,), (64,), (65,)], "n long").select(text.chunk_count(F.col("n"), 64).alias("c"))
    assert [r.c for r in counts.collect()] == [1, 1, 2]


def test_worked_sequences(spark):
    rows = spark.createDataFrame(list(enumerate([5, 5, 7, 7, 7, 5])), "i long, v long").withColumn("k", F.lit(1))
    assert [r.run for r in sequences.run_ids(rows, "k", "i", "v").orderBy("i").collect()] == [1, 1, 2, 2, 2, 3]
    parts = spark.createDataFrame([(1, 0, x) for x in (1, 1, 2)] + [(1, 1, x) for x in (1, 2, 2)], "k long, part long, id long")
    assert sorted(r.joined for r in sequences.offset_concat(parts, "k", "part", "id").collect()) == [1, 1, 2, 3, 4, 4]
    v = one(spark, v=list(range(8)))
    shares = {k: [v.select(sequences.sequence_split(F.col("v"), 2, r, k).alias("s")).first().s for r in (0, 1)] for k in ("zigzag-ring", "ulysses")}
    assert shares == {"zigzag-ring": [[0, 1, 6, 7], [2, 3, 4, 5]], "ulysses": [[0, 1, 2, 3], [4, 5, 6, 7]]}


def softmax_mean(q, k, v, heads, kv_heads, scale):
    out = []
    for h in range(heads):
        own = slice(h // (heads // kv_heads) * len(k[0]) // kv_heads, (h // (heads // kv_heads) + 1) * len(k[0]) // kv_heads)
        part = q.reshape(heads, -1)[h]
        w = np.exp(scale * (k[:, own] @ part) - max(scale * (k[:, own] @ part)))
        out += (w @ v[:, own] / w.sum()).tolist()
    return out


@pytest.mark.parametrize("heads,kv_heads", [(4, 4), (4, 2), (4, 1)])
def test_readout_equals_softmax(spark, heads, kv_heads):
    """Chunks in many batches, huge scores, a document that two queries chose, one query without documents; no template and one."""
    rng = np.random.default_rng(heads + kv_heads)
    width = 3 * kv_heads
    memory = [(k // 4, (rng.normal(size=width) * 30).tolist(), rng.normal(size=width).tolist()) for k in range(60)]
    tokens = [(q, t, rng.normal(size=12).tolist(), rng.normal(size=width).tolist(), rng.normal(size=width).tolist()) for q in range(4) for t in range(1 + q)]
    won = [(0, 3), (0, 7), (1, 7), (1, 14), (2, 0)]
    table = spark.createDataFrame(memory, "doc_id long, k array<double>, v array<double>").repartition(7)
    asked = spark.createDataFrame(tokens, "query_id long, tok long, q array<double>, k array<double>, v array<double>")
    chosen = spark.createDataFrame(won, "query_id long, doc_id long")
    for template in ([], [(memory[0][1], memory[1][2]), (memory[2][1], memory[3][2])]):
        got = {(r.query_id, r.tok): r.vec for r in readout.read_out(table, chosen, asked, template, heads, kv_heads, 0.5).collect()}
        assert len(got) == len(tokens)
        for query, tok, q, _, _ in tokens:
            seen = [*template, *((m[1], m[2]) for m in memory if (query, m[0]) in won), *((t[3], t[4]) for t in tokens if t[0] == query and t[1] <= tok)]
            want = softmax_mean(np.array(q), *(np.array([s[j] for s in seen]) for j in (0, 1)), heads, kv_heads, 0.5)
            assert got[query, tok] == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("laid_out", [True, False])
def test_mean_routing_hands_on_few_rows(spark, laid_out):
    """Documents whole within a task compete there; scattered ones are added up after it, with the same result."""
    rng = np.random.default_rng(3)
    rows = [(k // 5, k, rng.normal(size=8).tolist()) for k in range(2000)]
    chunks = spark.createDataFrame(rows, routing.CHUNKS)
    chunks = chunks.repartitionByRange(4, "chunk_id").sortWithinPartitions("chunk_id") if laid_out else chunks.repartition(4, "chunk_id")
    asked = [(q, t, rng.normal(size=8).tolist()) for q in range(6) for t in (0, 1)]
    config = MemoryConfig(heads=2, top_k=3, chunk="mean")
    sized = chunks.withColumn("n_chunks", F.lit(5))
    parts = routing.partial_scores(sized, asked, config).count()
    assert parts <= 6 * 4 * (3 + 2) if laid_out else parts > 6 * 400
    vectors = np.array([r[2] for r in rows]).reshape(400, 5, 8)
    for q in range(6):
        scores = np.max([vectors @ np.array(a[2]) / 2 for a in asked if a[0] == q], axis=0).mean(axis=1)
        want = np.argsort(-scores)[:3].tolist()
        tokens = spark.createDataFrame([a for a in asked if a[0] == q], routing.TOKENS)
        assert [r.doc_id for r in routing.route(chunks if q % 2 else sized, tokens, config).orderBy("rank").collect()] == want


def tied_vectors(folder):
    """A view of 3,000 vectors as embeddings, every 24th a copy; one has a head of zeros."""
    made = np.random.default_rng(5).normal(size=(3000, 64)).astype(np.float32)
    made[5::24] = made[200]
    made[78, :8] = 0
    con = duckdb.connect()
    con.from_arrow(pa.table({"vec_id": range(3000), "embedding": made.tolist()}, pa.schema({"vec_id": pa.int64(), "embedding": pa.list_(pa.float32())}))).write_parquet(f"{folder}/embeddings.parquet")
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    return con


def test_recall_lists_of_equal_vectors(spark, tmp_path):
    con = tied_vectors(tmp_path)
    got = sorted(tuple(r) for r in QUERIES["recall_fanin"](spark, str(tmp_path)).select("request", "layer", "lists").collect())
    assert got == sorted(con.sql(ORACLE_SQL["recall_fanin"]).select("request, layer, lists").fetchall())
    assert got[1][2] == "0,3,6;37,50,62"


@pytest.mark.parametrize("score", ["dot", "cosine"])
def test_equal_vectors_tie(spark, tmp_path, score):
    """A vector's cosine with itself is 1 and copies score alike wherever they stand, to the last bit of the SQL; ties go to the smaller id."""
    con = tied_vectors(tmp_path)
    config = MemoryConfig(score=score)
    chunks, tokens = plans.chunks(spark, str(tmp_path)), plans.tokens(spark, str(tmp_path))
    for parts in (1, 7):
        got = [tuple(r) for r in routing.route(chunks.repartition(parts), tokens, config).select("query_id", "rank", "doc_id", "score").sort("query_id", "rank").collect()]
        assert got == con.sql(plans.scores_sql(config, True) + "SELECT query_id, rank, doc_id, score FROM ranked WHERE rank <= 16 ORDER BY ALL").fetchall()
        held = [k // 8 for k in range(29, 3000, 24) if k // 8 != 12]  # this one holds a token of its own
        tied = [d for q, _, d, _ in got if q == 0 and d in held]
        assert len(tied) > 10 and tied == held[: len(tied)]
        if score == "cosine":
            assert all([(d, s) for q, r, d, s in got if q == n and r <= 3] == [((3 * n + k) * 100 // 8, 1.0) for k in range(3)] for n in range(1, 10))


def test_masked_scores(spark):
    """Pads of any values, on any side, leave the same scores; a sample without tokens has none."""
    rng = np.random.default_rng(1)
    kind = "sample long, q array<array<double>>, q_mask array<int>, k array<array<double>>, k_mask array<int>"
    made = []
    for pad in (0.0, 1e9):
        rows = []
        for s in range(6):
            own = np.random.default_rng(s)
            q, k = own.normal(size=(s, 4)), own.normal(size=(5 - s // 2, 4))
            rows.append((s, [[pad] * 4] * (6 - s) + q.tolist(), [0] * (6 - s) + [1] * s, [[pad] * 4] + k.tolist() + [[pad] * 4] * (s // 2), [0] + [1] * len(k) + [0] * (s // 2)))
        rng.shuffle(rows)
        table = spark.createDataFrame(rows, kind)
        made.append({how: sorted(tuple(r) for r in routing.masked_scores(table, MemoryConfig(heads=2, query=how)).collect()) for how in ("max", "mean", "last")})
    assert made[0] == made[1]
    for how, reduce in (("max", lambda x: x.max(0)), ("mean", lambda x: x.mean(0)), ("last", lambda x: x[-1])):
        for s in range(6):
            own = np.random.default_rng(s)
            q, k = own.normal(size=(s, 4)), own.normal(size=(5 - s // 2, 4))
            found = [(c, x) for i, c, x in made[0][how] if i == s]
            assert [c for c, _ in found] == list(range(1, len(k) + 1))
            assert [x for _, x in found] == (pytest.approx(reduce(q @ k.T / 2).tolist()) if s else [None] * len(k))


def test_late_fetch_reads_the_winners_files(spark, tmp_path):
    rows = [(k // 3, k, [float(k)], [float(-k)], [float(k % 7)]) for k in range(3000)]
    memory = spark.createDataFrame(rows, "doc_id long, chunk_id long, k array<double>, v array<double>, rk array<double>").repartition(5)
    snapshots.place_memory(memory, f"{tmp_path}/m", rows_per_file=100)
    assert snapshots.read_placed(spark, f"{tmp_path}/m", "rk").where("n_chunks = 3").count() == 3000
    wanted = spark.createDataFrame([(5,), (5,), (6,), (900,), (None,), (10**6,), (-1,)], "doc_id long")
    got = snapshots.fetch_placed(spark, f"{tmp_path}/m", wanted, "v")
    assert sorted((r.doc_id, r.chunk_id, r.v) for r in got.collect()) == [(d, 3 * d + j, [-float(3 * d + j)]) for d in (5, 6, 900) for j in range(3)]
    sizes = {f: os.path.getsize(f"{tmp_path}/m/placed/{f}") for f in os.listdir(f"{tmp_path}/m/placed") if f.endswith(".parquet")}
    read = [f.rpartition("/")[2] for f in got.inputFiles()]
    assert len(sizes) > 20 and len(read) <= 3 and sum(sizes[f] for f in read) < sum(sizes.values()) / 8
    assert "ReadSchema: struct<doc_id:bigint,chunk_id:bigint,v:array<double>>" in got._jdf.queryExecution().toString()
    assert snapshots.fetch_placed(spark, f"{tmp_path}/m", wanted.where("doc_id < 0"), "v").collect() == []


def test_worked_metrics(spark):
    row = metrics.set_metrics(spark.createDataFrame([([1, 2, 3], [2, 3, 9, 9]), ([], [1])], "t array<int>, p array<int>"), "t", "p").collect()
    assert [round(x, 4) for x in row[0][2:]] == [0.6667, 0.6667, 0.6667, 0.5] and list(row[1][2:]) == [0, 0, 0, 0]
    scored = spark.createDataFrame([(1, 0.2, 1), (1, 0.1, 0), (1, -0.1, 1)], "sample long, score double, y int")
    want = {"infonce": 1.849012, "decoupled": 1.220095, "focal": 1.574104, "multi_focal": 0.836368, "bce": 13.3}
    for kind, loss in want.items():
        assert metrics.losses(scored, kind).first().loss == pytest.approx(loss, abs=2e-6)


@pytest.mark.parametrize("head,query,chunk,a,b", [
    ("mean", "max", "max", 1.5, 3), ("mean", "max", "mean", 1.5, 3), ("mean", "mean", "max", 1.25, 2), ("mean", "mean", "mean", 0.375, 2), ("mean", "last", "max", 1, 3),
    ("mean", "last", "mean", -0.75, 3), ("max", "max", "max", 4, 6), ("max", "max", "mean", 3.5, 6), ("max", "mean", "max", 2.5, 4), ("max", "mean", "mean", 1.75, 4),
    ("max", "last", "max", 3, 6), ("max", "last", "mean", 0.5, 6),
])
def test_worked_routing(spark, head, query, chunk, a, b):
    chunks = spark.createDataFrame([(1, 0, [1.0, 1.0]), (1, 1, [-1.0, 2.0]), (2, 2, [2.0, 0.0])], routing.CHUNKS)
    tokens = spark.createDataFrame([(0, 0, [1.0, 2.0]), (0, 1, [3.0, -1.0])], routing.TOKENS)
    got = routing.route(chunks, tokens, MemoryConfig(heads=2, head=head, query=query, chunk=chunk))
    assert {r.doc_id: round(r.score, 9) for r in got.collect()} == {1: a, 2: b}


def test_blocks_of_queries_give_the_same(spark):
    rng = np.random.default_rng(0)
    chunks = spark.createDataFrame([(k // 3, k, rng.normal(size=8).tolist()) for k in range(300)], routing.CHUNKS)
    tokens = spark.createDataFrame([(k // 2, k % 2, rng.normal(size=8).tolist()) for k in range(40)], routing.TOKENS)
    config = MemoryConfig(heads=2, top_k=5)
    whole = sorted(routing.best_documents(routing.document_scores(chunks, tokens, config), 5).collect())
    assert sorted(routing.best_documents(routing.document_scores(chunks, tokens, config, most=7), 5).collect()) == whole
    assert sorted(routing.route_sharded(chunks, tokens, config, 4).collect()) == whole


def test_packed_examples_equal_plain(spark):
    rng = random.Random(3)
    rows = [(i, [rng.randrange(9) + 1 for _ in range(rng.choice([0, 1, 3, 7, 14, 15, 16]))]) for i in range(60)]
    table = spark.createDataFrame([(i, x, x) for i, x in rows], "id long, input_ids array<long>, labels array<long>").repartition(3)
    own = [x for _, x in rows if len(x) < 15]
    numbers, want = plain_bags([len(x) for x in own], 15), []
    for bag in sorted(set(numbers)):
        inside = [x for x, b in zip(own, numbers) if b == bag]
        ids, places = sum(inside, []), [k for x in inside for k in range(len(x))]
        gap = 16 - len(ids)
        want.append((bag, ids + [0] * gap, ids[1:] + [-100] * (16 - len(ids[1:])), [1] * len(ids) + [0] * gap, places + [15] * gap))
    got = packing.packed_examples(table, "id", 16, 0)
    assert sorted(map(tuple, got.collect())) == want
    shares = [packing.split_columns(got, 2, r, "ulysses").orderBy("bag").collect() for r in (0, 1)]
    for a, b, w in zip(*shares, want):
        assert a.input_ids + b.input_ids == w[1] and a.attention_mask == b.attention_mask == w[3]


def test_sizes_for_readers(spark):
    want = {0: "0B", 1: "1B", 1023: "1023B", 1024: "1K", 1536: "2K", 2560: "2K", 1048575: "1024K", 3 << 20: "3M", 1 << 30: "1.0G", 1536 << 20: "1.5G", 5 << 40: "5.0T", 389 << 38: "97.2T", 391 << 38: "97.8T", 3000 << 50: "3000.0P"}
    rows = spark.createDataFrame([(k,) for k in want], "n long")
    assert {r.n: r.said for r in rows.select("n", text.human_bytes(F.col("n")).alias("said")).collect()} == want


def test_settings_are_read(spark, tmp_path):
    for name, body in {"a": '{"x": 1, "memory": {"doc_top_k": 5, "pooling_kernel_size": 32, "other": "all"}}', "b": '{"memory":\n{"top_k_docs": 9}}', "c": '{"x": 1}'}.items():
        (tmp_path / name).write_text(body)
    assert read_config(spark, f"{tmp_path}/a", "memory") == MemoryConfig(top_k=5, pool=32)
    assert read_config(spark, f"{tmp_path}/b", "memory") == MemoryConfig(top_k=9)
    with pytest.raises(ValueError, match="has no"):
        read_config(spark, f"{tmp_path}/c", "memory")


@pytest.mark.parametrize("width", [1, 7, 4096])
def test_runs_of_a_hot_key(spark, width):
    rng = random.Random(5)
    rows = [(None if k % 11 == 0 else "hot" if k % 3 else f"k{k % 5}", k * 2 - 300, rng.choice(["a", "a", "a", "b", None])) for k in range(600)]
    last, runs, want = {}, {}, []
    for key, at, value in rows:
        if key not in last or last[key] != value:
            runs[key] = runs.get(key, 0) + 1
        last[key] = value
        want.append((at, runs[key]))
    table = spark.createDataFrame(rows, "key string, at long, value string").repartition(5)
    got = sequences.run_ids(table, "key", "at", "value", width=width)
    assert got.columns == ["key", "at", "value", "run"]
    assert sorted((r["at"], r["run"]) for r in got.collect()) == want
    assert sequences.run_ids(table.limit(0), "key", "at", "value", width=width).collect() == []


@pytest.mark.parametrize("parts", [1, 5])
def test_ordinals_over_any_key(spark, parts):
    """A third of the rows has one key, some have none, and some rows are equal."""
    rng = random.Random(7)
    rows = [(("hot" if k % 3 == 0 else None if k % 7 == 0 else f"k{rng.randrange(40)}"), rng.randrange(50), 1) for k in range(900)] + [("k1", 1, 1)] * 5
    table = spark.createDataFrame(rows, "key string, n long, _at int").repartition(6)
    got = sequences.ordinals(table, F.desc("key"), "n", parts=parts)
    assert got.columns == ["key", "n", "_at", "ordinal"]
    got = sorted((r.ordinal, r.key, r.n) for r in got.collect())
    assert [g[0] for g in got] == list(range(905))
    want = sorted(rows, key=lambda r: r[1])
    want = sorted([r for r in want if r[0] is not None], key=lambda r: r[0], reverse=True) + [r for r in want if r[0] is None]
    assert [g[1:] for g in got] == [r[:2] for r in want]
    assert sequences.ordinals(table.limit(0), "key").collect() == []


@pytest.mark.parametrize("width", [1, 7, 4096])
def test_offsets_ranks_and_parts_of_a_hot_key(spark, width):
    rng = random.Random(width)
    rows = [(None if k % 11 == 0 else "hot" if k % 3 else f"k{k % 5}", k * 2 - 300, rng.randrange(9), k // 40) for k in range(600)]
    table = spark.createDataFrame(rows, "key string, at long, n long, run long").repartition(5)
    sums, places, want = {}, {}, {}
    for key, at, n, run in rows:
        want[at] = (sums.get(key, 0), places.get((key, run), 0))
        sums[key], places[key, run] = sums.get(key, 0) + n, places.get((key, run), 0) + 1
    got = sequences.exclusive_offsets(table, "key", "at", "n", width=width)
    assert got.columns == ["key", "at", "n", "run", "offset"]
    assert {r["at"]: r["offset"] for r in got.collect()} == {at: w[0] for at, w in want.items()}
    assert {r["at"]: r["rank"] for r in sequences.rank_in_run(table, "key", "at", "run", width).collect()} == {at: w[1] for at, w in want.items()}
    order = {}
    for key, at, n, _ in sorted(rows, key=lambda r: (-r[2], r[1])):
        order[at] = sum(1 for k, a, m, _ in rows if k == key and (-m, a) < (-n, at))
    assert {r["at"]: r["place"] for r in sequences.ranked(table, "key", F.desc("n"), "at", name="place").collect()} == order


def test_corpora(spark):
    docs = spark.createDataFrame([(3, "a"), (5, "b"), (7, "a"), (9, None), (11, "c")], "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (4, "c"), (5, "a")], "n long, label string")
    assert sorted(map(tuple, corpora.ids_of(asked, docs, name="found").collect())) == [(1, "a", 7), (2, "x", None), (3, None, None), (4, "c", 11), (5, "a", 7)]
    texts, labels, scale = ["a", "b", "a", "c"], {"b"}, 3
    context = texts + [f"{t}_copy{bias}" for bias, t in enumerate(texts * scale) if t not in labels]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known = spark.createDataFrame([(t,) for t in labels], "text string")
    assert sorted(map(tuple, corpora.scaled(table, known, scale).collect())) == list(enumerate(context))
    assert sorted(r.text for r in corpora.scaled(table, known, 0).collect()) == sorted(texts)
    found = spark.createDataFrame([(0, 18, 1, [4]), (0, 18, 0, [2, 3]), (1, 18, 0, [])], "request long, layer long, seq long, ids array<long>")
    assert sorted((r.request, r.lists) for r in corpora.recall_lists(found).collect()) == [(0, [[2, 3], [4]]), (1, [[]])]


def test_block_arrays_equal_a_mask(spark):
    """What a token sees, from a first place to its own, is the block-diagonal causal mask of roles in order."""
    docs = spark.createDataFrame([(1, 5, ["a", "b"]), (1, 9, ["c"]), (1, 7, ["d", "e", "f"]), (2, 1, []), (2, 2, ["g"])], "block long, doc long, tokens array<string>")
    packed = prompts.block_arrays(prompts.block_tokens(docs, "block", "doc", "tokens", F.array(F.lit("x"), F.lit("y"))), "block")
    rows = {r.block: r for r in packed.withColumn("seen", prompts.seen_from(F.col("starts"), F.size("tokens"))).collect()}
    assert rows[1].tokens == list("xyabdefc") and rows[1].positions == [0, 1, 0, 1, 0, 1, 2, 0] and rows[1].starts == [0, 2, 4, 7]
    assert rows[2].tokens == list("xyg") and rows[2].roles == [prompts.TEMPLATE] * 2 + [prompts.DOCUMENT]
    segment = [0, 0, 1, 1, 2, 2, 2, 3]
    mask = [[segment[i] == segment[j] and j <= i for j in range(8)] for i in range(8)]
    assert [[rows[1].seen[i] <= j <= i for j in range(8)] for i in range(8)] == mask
    roles = one(spark, t="why so").select(prompts.asked_roles(text.tokens(F.col("t")), 3, 1).alias("r")).first().r
    assert roles == [prompts.QUERY] * 2 + [prompts.TEMPLATE] * 2 + [prompts.RESPONSE]


def test_padding_of_roles_and_positions(spark):
    rows = spark.createDataFrame([(0, [5, 6, 7], [0, 0, -1], [4, 5, 6]), (0, [8], [-2], [9]), (0, [], [], [])], "b int, ids array<long>, roles array<long>, at array<long>")
    got = sequences.left_pad(rows, "b", "ids", 1, "roles", "at").collect()
    assert sorted((r.padded, r.mask, r.padded_roles, r.padded_positions) for r in got) == [([1, 1, 1], [0, 0, 0], [0, 0, 0], [0, 0, 0]), ([1, 1, 8], [0, 0, 1], [0, 0, -2], [9, 9, 9]), ([5, 6, 7], [1, 1, 1], [0, 0, -1], [4, 5, 6])]


def test_judged_results_and_checks(spark, tmp_path):
    rows = spark.createDataFrame([("q", "a", "b", 3), ("r", "a", "c", 4)], "question string, true_answer string, pred_answer string, pred_score int")
    assert snapshots.write_judged(rows, f"{tmp_path}/j") == 3.5
    assert spark.read.json(f"{tmp_path}/j/records").count() == 2
    asked = spark.createDataFrame([("a b",), (" ",)], "q string")
    length = text.token_count(F.col("q"))
    good = spark.createDataFrame([("a b",)], "q string")
    assert prompts.checked(good, "q", length, 2).first().q == "a b"
    for bad, most in ((asked, 2), (good, 1)):
        with pytest.raises(Exception, match="a query is"):
            prompts.checked(bad, "q", length, most).collect()


def test_sources(spark, tmp_path):
    (tmp_path / "q.json").write_text('[{"question": "a", "labels": ["x"], "answer": "b", "other": 1}]')
    spark.createDataFrame([("a", ["x"], "b")], "query string, reference_list array<string>, answer string").write.parquet(f"{tmp_path}/q.parquet")
    spark.createDataFrame([(1, "t")], "doc_id int, text string").write.parquet(f"{tmp_path}/m.parquet")
    known = registry.Registry([registry.Spec("one", f"{tmp_path}/q.json", f"{tmp_path}/m.parquet")])
    assert known.queries(spark, "one").collect() == registry.read_queries(spark, f"{tmp_path}/q.parquet").collect() == [("a", ["x"], "b")]
    assert known.memory(spark, "one").first() == (1, "t") and known.frame(spark).count() == 1
    with pytest.raises(ValueError, match="one"):
        known["two"]
    with pytest.raises(ValueError):
        registry.read_memory(spark, "x.pkl")
    (tmp_path / "m.json").write_text('["one", "two\\nlines", ""]')
    (tmp_path / "m.jsonl").write_text('{"doc_id": 4, "text": "x"}')
    assert sorted(registry.read_memory(spark, f"{tmp_path}/m.json").collect()) == [(0, "one"), (1, "two\nlines"), (2, "")]
    assert registry.read_memory(spark, f"{tmp_path}/m.jsonl").collect() == [(4, "x")]
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "a.json").write_text('{"anonymous": {"precision": [{"question": "q", "true_answer": "t",\n "pred_answer": "p"}]}}')
    (tmp_path / "out" / "a_score.json").write_text('{"anonymous": 1}')
    assert snapshots.read_answers(spark, f"{tmp_path}/out").collect() == [("a.json", "q", "t", "p")]


@pytest.mark.parametrize("split", [100, 1 << 27])
def test_json_list_in_parallel(spark, tmp_path, split):
    """Splits fall into texts, escapes and signs of several bytes; numbers follow the list, errors name their place."""
    rng = random.Random(split)
    signs = ['"', "\\", "\n", "é", "漢", "[", ",", "]", " ", "a", "{", "\U0001f600", '\\"', "\t"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(0, 20))) for _ in range(30)] + ["", "\\", '"', "x" * 300]
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        for name, body in {"a": json.dumps(texts), "b": json.dumps(texts, ensure_ascii=False, indent=2), "c": " [ ] ", "d": '[""]', "e": json.dumps(["one"]) + "\n"}.items():
            (tmp_path / f"{name}.json").write_text(body)
            want = json.loads(body)
            got = registry.read_memory(spark, f"{tmp_path}/{name}.json")
            assert sorted(map(tuple, got.collect())) == list(enumerate(want))
        if split == 100:
            assert spark.read.option("lineSep", '"').text(f"{tmp_path}/a.json").rdd.getNumPartitions() > 10
        for body, where in (('["a", 1, "b"]', "before text 1"), ('["a" "b"]', "before text 1"), ('["a", "b"', "before its bracket"), ('["a", "b', "before its bracket"), ('{"a": ["b"]}', "before text 0"), ('["a", "b"] "c"', "before its bracket"), ("", "isn't a list")):
            (tmp_path / "bad.json").write_text(body)
            with pytest.raises(ValueError, match=where):
                registry.read_memory(spark, f"{tmp_path}/bad.json")
        (tmp_path / "escape.json").write_text('["a\\q"]')
        with pytest.raises(Exception, match="MALFORMED|FAILFAST|Unrecognized"):
            registry.read_memory(spark, f"{tmp_path}/escape.json").collect()
    finally:
        for key in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{key}")


def test_snapshots(spark, tmp_path):
    rows = [(layer, k, k, [float(k), 1.0]) for layer in (18, 19) for k in range(5)]
    built = []
    build = lambda: built.append(1) or spark.createDataFrame(rows, snapshots.MEMORY)
    path = f"{tmp_path}/{snapshots.snapshot_key('c', 'e', MemoryConfig())}"
    for _ in range(2):
        assert sorted(tuple(r[c] for c in ("layer", "doc_id", "chunk_id", "vec")) for r in snapshots.memory_or_build(spark, path, build).collect()) == rows
    assert built == [1] and snapshots.read_memory(spark, path, [18]).count() == 5
    with pytest.raises(ValueError, match="5 documents"):
        snapshots.memory_or_build(spark, path, build, n_docs=6)
    parts = spark.createDataFrame([(0, 1, 2, [1.0], [2.0], [3.0])], "layer int, doc_id long, chunk_id long, k array<double>, v array<double>, rk array<double>")
    snapshots.write_memory(parts, f"{tmp_path}/parts")
    assert snapshots.read_memory(spark, f"{tmp_path}/parts", [0], ["rk"]).collect() == [(0, 1, 2, [3.0])]
    for value in (1, 2):
        snapshots.upsert_results(spark.createDataFrame([("a", value)] + [("b", 7)] * (value == 1), "case string, v long"), f"{tmp_path}/r")
    assert sorted((r["case"], r["v"]) for r in snapshots.read_results(spark, f"{tmp_path}/r").collect()) == [("a", 2), ("b", 7)]


def test_interleave(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one"), (2, "two")], "doc_id long, text string")
    queries = spark.createDataFrame([(0, "q0"), (1, "q1"), (2, "q2")], "query_id long, prompt string")

    def generate(state):
        asked = F.when(F.col("query_id") == 2, F.lit(f"[9]{text.OBJECT_END}")).when(F.col("prompt").contains(f"[2]. two\n{text.OBJECT_END}"), F.lit(f"{text.ANSWER} yes"))
        return state.withColumn("out", F.when(F.col("query_id") == 0, F.lit("at once")).otherwise(F.coalesce(asked, F.lit(f"[2] [7]{text.OBJECT_END}"))))

    got = interleave.interleave(queries, docs, generate, str(tmp_path), most=3)
    assert sorted((r.query_id, r.rounds, r.out) for r in got.collect()) == [(0, 1, "at once"), (1, 2, f"{text.ANSWER} yes"), (2, 3, f"[9]{text.OBJECT_END}")]


def test_interleave_ends_retrieval(spark, tmp_path):
    """The end of retrieval puts the question once more; a later round that says more than an id is followed by one last round."""
    docs = spark.createDataFrame([(1, "one")], "doc_id long, text string")
    asked = f"{text.HISTORY}why?\n{text.REQUEST}"
    queries = spark.createDataFrame([(0, asked), (1, "p"), (2, "r")], "query_id long, prompt string")

    def generate(state):
        q, p = F.col("query_id"), F.col("prompt")
        again = p.endswith(f"{text.RETRIEVE_END}{text.START}{text.QUESTION} why?\n{text.OBJECT_END}")
        zero = F.when(again, f"{text.ANSWER} so").otherwise(text.RETRIEVE_END)
        one = F.when(p.endswith(f"x [1]{text.OBJECT_END}"), "last").when(p.contains("[1]. one"), f"x [1]{text.OBJECT_END}").otherwise(f"[1]{text.OBJECT_END}")
        two = F.when(F.length("prompt") > 1000, "long").otherwise(F.concat(F.lit("y" * 1001), F.lit(text.OBJECT_END)))
        return state.withColumn("out", F.when(q == 0, zero).when(q == 1, one).otherwise(two))

    got = interleave.interleave(queries, docs, generate, str(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == [(0, 2, f"{text.ANSWER} so"), (1, 3, "last"), (2, 2, "long")]


def test_hooks(spark):
    docs = spark.createDataFrame([(1, ["a", "bb", "ccc"]), (2, []), (3, None)], "doc_id long, tokens array<string>")
    rows = sorted(tuple(r) for r in hooks.encoded(docs, hooks.running_means, 2).collect())
    assert rows == [(1, 0, [1.25, 97.25], [1.5, 97.5], [97.25, 1.25]), (1, 1, [2.0, 98.0], [3.0, 99.0], [98.0, 2.0])]

    def strict():
        def judge(question, true, predicted):
            if predicted == "bad":
                raise RuntimeError("no reply")
            return "Score: 4"

        return judge

    asked = spark.createDataFrame([("q", "t", "p"), ("q", "t", "bad")], "q string, t string, p string")
    assert [(r.reply, r.pred_score) for r in hooks.scored(asked, strict, "q", "t", "p").orderBy("p").collect()] == [("", 0), ("Score: 4", 4)]
    vs = spark.createDataFrame([(0, [1.0, 2.0]), (1, None)], "i long, v array<double>")
    assert [r[0] for r in vs.orderBy("i").select(hooks.projection(np.array([[1.0, 1.0], [0.0, -1.0]]))(F.col("v"))).collect()] == [[3.0, -2.0], None]


def test_sampled_tokens_follow_the_softmax(spark):
    logits = spark.range(4000).select("id", F.explode(F.array(*[F.struct(F.lit(t).alias("token"), F.lit(x).alias("logit")) for t, x in enumerate((0.0, 1.0, 2.0))])).alias("x")).select("id", "x.*")
    want = np.exp(np.arange(3) / 0.5) / np.exp(np.arange(3) / 0.5).sum()
    drawn = dict(routing.sampled_token(logits, "id", "token", "logit", 0.5, 1).groupBy("token").count().collect())
    assert [drawn.get(t, 0) / 4000 for t in range(3)] == pytest.approx(want.tolist(), abs=0.03)
    assert routing.sampled_token(logits, "id", "token", "logit", 0, 1).where("token <> 2").isEmpty()


def test_training_shares_keep_every_example(spark):
    rng = random.Random(5)
    rows = [(i, [i] * rng.randrange(1, 12)) for i in range(300)]
    table = spark.createDataFrame([(i, x, x) for i, x in rows], "id long, input_ids array<long>, labels array<long>")
    seen = []
    for seed in (1, 1, 2):
        shares = packing.training_shares(table, "id", seed, 16, -1, 2, "ulysses").collect()
        whole = {}
        for r in sorted(shares, key=lambda r: (r.bag, r.rank)):
            assert len(r.input_ids) == len(r.labels) == len(r.position_ids) == 8 and len(r.attention_mask) == 16
            whole.setdefault(r.bag, []).extend(r.input_ids)
        assert sorted(t for ids in whole.values() for t in ids if t >= 0) == sorted(t for _, x in rows for t in x)
        seen.append(whole)
    assert seen[0] == seen[1] != seen[2]


def minute(n):
    return datetime(2024, 1, 1) + timedelta(minutes=n)


def state_rows(query):
    """Rows of state after each batch."""
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]


def test_streams_equal_batches(spark, tmp_path):
    """A query's tokens come in files and batches of their own, some twice; it is answered once, as in a batch."""
    rng = np.random.default_rng(0)
    memory = spark.createDataFrame([(k // 3, k, rng.normal(size=8).tolist()) for k in range(90)], routing.CHUNKS)
    tokens = [(q, t, 2, rng.normal(size=8).tolist(), minute(t)) for t in (0, 1) for q in range(6)]
    whole = tokens.copy()
    tokens += [tokens[0], (9, 0, 2, [0.0] * 8, minute(1))]
    for part in (tokens[:1], tokens[12:13], tokens[1:7], tokens[7:12], tokens[13:]):
        spark.createDataFrame(part, requests.REQUESTS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    config = MemoryConfig(heads=2, top_k=3)
    stream = requests.request_stream(spark, f"{tmp_path}/in", requests.REQUESTS, files=1)
    query = requests.serve(stream, memory, config, f"{tmp_path}/out", f"{tmp_path}/state")
    query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").drop("batch")
    want = routing.route(memory, spark.createDataFrame(whole, requests.REQUESTS), config)
    key = lambda r: (r.query_id, r.rank)
    assert [(key(r), r.doc_id) for r in sorted(got.collect(), key=key)] == [(key(r), r.doc_id) for r in sorted(want.collect(), key=key)]
    # Only the query that lacks a token is still held: its token, and its timer in two indexes.
    assert max(state_rows(query)) > state_rows(query)[-1] <= 3


def test_parts_are_gathered_and_abandoned_state_goes(spark, tmp_path):
    schema = "k long, p long, n long, v string, ts timestamp"
    batches = [[(1, 1, 2, "b", minute(0)), (2, 0, 1, "z", minute(0)), (3, 1, 3, "y", minute(0))], [(1, 0, 2, "a", minute(1)), (3, 1, 3, "y", minute(2))], [(4, 0, 1, "late", minute(500))]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    found = requests.gathered(requests.request_stream(spark, f"{tmp_path}/in", schema, files=1), "k", "p", "n", "v")
    query = requests.appended(found, f"{tmp_path}/out", f"{tmp_path}/state")
    query.awaitTermination()
    assert sorted((r.k, r.parts) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [(1, ["a", "b"]), (2, ["z"]), (4, ["late"])]
    assert max(state_rows(query)) > 0 == state_rows(query)[-1]


def test_rounds_keep_state(spark, tmp_path):
    schema = "conv_id long, turn long, done boolean, ts timestamp"
    batches = [[(1, 0, False, minute(0)), (2, 0, True, minute(0))], [(1, 1, True, minute(1)), (3, 0, False, minute(1))], [(1, 2, False, minute(2)), (3, 1, False, minute(2))], [(4, 0, False, minute(300))]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    query = requests.appended(requests.rounds(requests.request_stream(spark, f"{tmp_path}/in", schema, files=1), most=2), f"{tmp_path}/out", f"{tmp_path}/state")
    query.awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [(1, 2), (2, 1), (3, 2)]
    # Requests that are over are forgotten an hour later; one that isn't is still held.
    assert state_rows(query)[-1] <= 3 < max(state_rows(query))


def test_rounds_end_within_a_batch(spark, tmp_path):
    """Turns that come together count up to the one that is done, or up to the most there may be."""
    rows = [(1, t, t == 1, minute(0)) for t in (3, 1, 0, 2)] + [(2, t, False, minute(0)) for t in range(5)]
    spark.createDataFrame(rows, "conv_id long, turn long, done boolean, ts timestamp").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = requests.request_stream(spark, f"{tmp_path}/in", "conv_id long, turn long, done boolean, ts timestamp")
    requests.appended(requests.rounds(stream, most=3), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [(1, 2), (2, 3)]


def test_windowed_counts(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    assert requests.windowed_counts(events).agg(F.sum("n")).first()[0] == events.count()


def test_stands_without_llm(tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for gone in (("llm", "corpus_pipeline.py"), ("llm",)):
        copy = tmp_path / str(len(gone))
        shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", *gone))
        said = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and set(e.oracle_sql()) <= set(q); assert not [k for k in q if k.startswith('op') or k == 'pipeline']"
        # Without this repository, but with what the surroundings themselves add.
        paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and os.path.realpath(p) != os.path.realpath(root)]
        env = os.environ | {"PYTHONPATH": os.pathsep.join([str(copy), *paths])}
        for command in (["-c", said], ["-m", "pytest", "--collect-only", "-q", "-p", "no:cacheprovider", "--rootdir", str(copy), "tests"]):
            done = subprocess.run([sys.executable, *command], cwd=copy, env=env, capture_output=True, text=True)
            assert done.returncode == 0, done.stdout + done.stderr
    missing = "import sys; sys.modules['tokenizers'] = None; import __spark_entry__ as e; assert e.llm is None and len(e.queries()) > 50"
    done = subprocess.run([sys.executable, "-c", missing], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    for folder, _, files in os.walk(f"{root}/memloom"):
        if "llm" not in folder.split(os.sep):
            for f in files:
                if f.endswith(".py"):
                    assert "memloom.llm" not in open(f"{folder}/{f}").read()
