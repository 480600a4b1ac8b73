"""The manifest against its SQL and a plain fold of lists."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from memloom.llm import merkle, queries

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes, arity):
    """The root of a list of digests, and each one's way up: what stands left and right of it."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for way, k in zip(ways, at):
            run = nodes[k // arity * arity : k // arity * arity + arity]
            way.append(("".join(run[: k % arity]), "".join(run[k % arity + 1 :])))
        nodes = [sha("".join(nodes[k : k + arity])) for k in range(0, len(nodes), arity)]
        at = [k // arity for k in at]
    return (nodes or [None])[0], ways


def plain(rows, arity):
    """rows: doc_id, source, lang, n_chars, text."""
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in order:
        own = sorted(langs[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((own, *tree([leaf(r) for r in own], arity)))
    root, tops = tree([t[1] for t in trees], arity)
    out = []
    for (own, subroot, ways), top in zip(trees, tops):
        for r, way in zip(own, ways):
            hit = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            h = leaf((*r[:3], r[3] + 1, r[4]) if hit else r)
            for left, right in way + top:
                h = sha(left + h + right)
            out.append((r[0], leaf(r), subroot, root, sha("".join(a + b for a, b in way + top)), h, h == root))
    return sorted(out, key=repr)


def got(report):
    return sorted((tuple(r[c] for c in COLUMNS) for r in report.collect()), key=repr)


ROWS = (
    [(k, f"s{k % 3}" if k % 5 else None, "en" if k % 3 else "de", k * 7 if k % 4 else None, f"text {k}\n" * (k % 4)) for k in range(90)]
    + [(None, "s", None, 1, "no id"), (None, "s", None, 1, "no id"), (None, None, None, None, None), (200, "s", "", 3, ""), (201, "s", "fr", 3, "é" * 200000), (7, "s", "en", 5, "again"), (7, "s", "en", 5, "again")]
    + [(300 + k, "s", f"l{k}", 2, "alone") for k in range(6)]
)


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_manifest_equals_plain(spark, arity):
    schema = "doc_id long, source string, lang string, n_chars long, text string, leaf int, tree string, i int, n int, h string, path int, other int"
    docs = spark.createDataFrame([(*r, 1, "x", 2, 3, "y", 4, 5) for r in ROWS], schema).repartition(3)
    assert got(merkle.manifest_report(docs, arity)) == plain(ROWS, arity)
    assert [r for r in plain(ROWS, arity) if not r[6]], "some leaves are tampered with"


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 8, 9])
def test_sizes_of_one_tree(spark, n):
    rows = [(k, "s", "en", k, "t") for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert got(merkle.manifest_report(docs)) == plain(rows, 2)


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = duckdb.sql(queries.ORACLE_SQL["op11_merkle_manifest"])
    assert sorted(want.columns) == sorted(COLUMNS)
    rows = sorted((tuple(r[want.columns.index(c)] for c in COLUMNS) for r in want.fetchall()), key=repr)
    assert got(queries.QUERIES["op11_merkle_manifest"](spark, sf)) == rows


def test_what_a_leaf_says(spark):
    """No two rows are written alike, and a tree of another arity has another root."""
    rows = spark.createDataFrame([("a", None), (None, "a"), ("", "a"), ("a1:", None), ("a", "")], "x string, y string")
    leaves = rows.select(merkle.text(merkle.digest(merkle.said(F.col("x")), merkle.said(F.col("y"))))).collect()
    assert len(set(leaves)) == 5
    with pytest.raises(ValueError, match="two children"):
        merkle.manifest(rows, ("x",), "x", "y", 1)
