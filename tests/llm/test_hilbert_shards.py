"""Shards: the curve, the laws, the files."""

import os
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from memloom.llm import hilbert_shards as h
from memloom.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, _curve int, _place string, n int, file string"
GRID = h.Grid(("lang", "source", "n_chars", "doc_id"), bits=3)


@pytest.mark.parametrize("n,bits", [(2, 1), (2, 4), (3, 3), (4, 2), (5, 2)])
def test_curve_visits_each_cell_by_single_steps(spark, n, bits):
    points = spark.createDataFrame(list(product(range(1 << bits), repeat=n)), ", ".join(f"c{k} int" for k in range(n)))
    found = points.withColumn("h", h.hilbert_index([F.col(f"c{k}") for k in range(n)], bits)).orderBy("h").collect()
    assert [r.h for r in found] == list(range(1 << bits * n))
    for a, b in zip(found, found[1:]):
        assert sum(abs(x - y) for x, y in zip(a[:n], b[:n])) == 1


def test_cells(spark):
    rows = spark.createDataFrame([(None,), (1.0,), (2.0,), (5.0,), (9.0,)], "x double")
    assert [r.c for r in rows.select(h.cell(F.col("x"), [2.0, 5.0]).alias("c")).collect()] == [0, 1, 2, 3, 3]
    words = spark.createDataFrame([(w,) for w in ("", "a", "ab", "b", "zebra crossing", "é", None)], "w string")
    numbers = [r.x for r in words.select(h.number(words, "w").alias("x")).collect()]
    assert numbers[:-1] == sorted(numbers[:-1]) and len(set(numbers[:-1])) == 6 and numbers[-1] is None


def rows_of(n):
    out = []
    for k in range(n):
        hot = k % 3 == 0
        out.append((k // 2 if k % 10 else None, "hot " * 9 if hot else None if k % 11 == 0 else "" if k % 13 == 0 else f"text {k} é", "en" if hot else ("de", None)[k % 2], "s" if hot else f"src{k % 5}", 36 if hot else k, "x", 1, "y", 2, "z"))
    out.append((5, "long " * 60000, "en", "s", 300000, "x", 1, "y", 2, "z"))
    return out + out[:3]


def plain(r):
    text = r[1] or ""
    return (r[0], len(text.encode()) + 1, zlib.crc32(text.encode()))


@pytest.mark.parametrize("law,n,run_rows", [("rows", 500, 40), ("rows", 500, 10**6), ("bytes", 500, 40), ("bytes", 500, 10**6), ("rows", 7, 2), ("bytes", 4, 100)])
def test_laws(spark, law, n, run_rows, tmp_path):
    docs = rows_of(n)
    made = h.write_shards(spark.createDataFrame(docs, SCHEMA).repartition(4), GRID, "doc_id", 16, law, path=str(tmp_path / "s"), run_rows=run_rows)
    got = h.read_shards(spark, made, ("doc_id", "text", made.curve, "shard", "file"), "own_shard", "own_slot").collect()
    assert sorted((plain(r) for r in got), key=repr) == sorted((plain(r) for r in docs), key=repr)
    assert all(r["shard"] == "x" and r["file"] == "z" for r in got)
    shards = [sorted((r for r in got if r.own_shard == s), key=lambda r: r.own_slot) for s in range(16)]
    assert all([r.own_slot for r in rows] == list(range(len(rows))) for rows in shards)
    order = [(r[made.curve], r.doc_id is not None, r.doc_id or 0) for rows in shards for r in rows]
    assert order == sorted(order)
    if law == "rows":
        assert max(map(len, shards)) - min(map(len, shards)) <= 1
    else:
        sizes = [sum(plain(r)[1] for r in rows) for rows in shards]
        assert max(abs(x - sum(sizes) / 16) for x in sizes) <= max(plain(r)[1] for r in docs)
    manifest = h.read_manifest(spark, made).collect()
    assert sum(r.n for r in manifest) == len(docs) and sum(r.bytes for r in manifest) == sum(plain(r)[1] for r in docs)
    root = str(tmp_path / "s" / "rows")
    on_disk = {os.path.relpath(os.path.join(d, f), root) for d, _, files in os.walk(root) for f in files if f.endswith(".parquet")}
    assert {r.file for r in manifest} == on_disk


def test_cut_runs_may_share_a_file(spark, tmp_path):
    """Small files are read together, so that one task writes the ends of several runs."""
    docs = rows_of(300)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        made = h.write_shards(spark.createDataFrame(docs, SCHEMA), GRID, "doc_id", 16, path=str(tmp_path / "s"), run_rows=10)
        got = h.read_shards(spark, made, ("doc_id",)).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    manifest = h.read_manifest(spark, made).collect()
    assert len({r.file for r in manifest}) < len(manifest)
    assert sorted((r["shard"], r.slot) for r in got) == [(s, k) for s in range(16) for k in range((s + 1) * len(docs) // 16 - s * len(docs) // 16)]


def test_files_are_pruned_by_several_columns(spark, tmp_path):
    """Conditions on either of two columns open few files; sorted by one, the other opens all."""
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), (F.xxhash64("id") % 1000).alias("x"), (F.xxhash64("id", F.lit(1)) % 1000).alias("y"))
    made = h.write_shards(rows, h.Grid(("x", "y")), "doc_id", 16, path=str(tmp_path / "s"), run_rows=60)
    manifest = h.read_manifest(spark, made)
    files = manifest.count()
    for name in ("x", "y"):
        chosen = h.files_for(manifest, **{name: (100, 160)})
        assert chosen.count() < files / 3
        read = spark.read.option("recursiveFileLookup", "true").parquet(f"{made.path}/rows").where(F.col(name).between(100, 160))
        assert {r.f for r in read.select(h.file_name().alias("f")).distinct().collect()} <= {r.file for r in chosen.collect()}
    assert h.files_for(manifest, x=(100, 160), y=(100, 160)).count() < files / 8


def test_empty_and_wrong(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for law in ("rows", "bytes"):
        assert h.shard_report(empty, GRID, 4, law).collect() == []
    with pytest.raises(ValueError, match="law"):
        h.write_shards(empty, GRID, "doc_id", law="key")
    with pytest.raises(ValueError, match="62 bits"):
        h.write_shards(empty, h.Grid(("doc_id",)), "doc_id")


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = queries.QUERIES["op12_hilbert_shards"](spark, sf).collect()
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in got) == sorted(plain((d.doc_id, d.text)) for d in docs)
    counts = [sum(r.shard == s for r in got) for s in range(16)]
    assert max(counts) - min(counts) <= 1 and {(r.law, r.grown_shard) for r in got} == {("rows", None)}
