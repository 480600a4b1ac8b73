"""Merkle manifest of a dataset: one root for all rows, and for each row the siblings that prove it.

A row's leaf is a digest of its columns.  The leaves of a group, in order, are
the lowest level of its tree.  Every level is joined with itself: a node looks
up the nodes whose index within the level is its own with the last bit turned
round (XOR, two to a parent) or its own moved by each offset among its parent's
slots (more to a parent).  What it finds are its siblings, and the rows of slot
zero emit the parents.  The groups' roots are the leaves of one more tree.
Paths are handed down from the root, each node's siblings before its parent's
path, so that a level of n nodes costs joins of n rows, 2n in all, on keys
(group, index) that are all distinct: a group with much of the table is spread
like any other.

Defined cases: a null is `-` in a leaf, unlike any text; an empty text is `0:`;
a null group is a group of its own and comes first, as does a null order;
rows of one order follow each other by their leaves, so equal rows are
interchangeable; a very long text is hashed whole, once; an empty table has no
root and no rows; columns that aren't named take no part, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memloom.llm.common import BROADCAST_BYTES, documents, join_unique
from memloom.operators.sequences import ordinals
from memloom.tables import discard, written

LEAF = ("doc_id", "source", "lang", "n_chars", "text")


def said(value: Column) -> Column:
    """A value with its length before it, so that no two rows of values are written alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    """The sha256 of the values' texts in a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*values), 256))


def text(digests: Column) -> Column:
    """Digests in a row as lowercase hex."""
    return F.lower(F.hex(digests))


def parent(left: Column, node: Column, right: Column) -> Column:
    return digest(text(left), text(node), text(right))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings on the way up (left and right of it) lead to."""
    return F.aggregate(path, leaf, lambda h, s: parent(s["left"], h, s["right"]))


def proof_text(path: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(text(s["left"]), text(s["right"]))), "")


def paired(nodes: DataFrame, arity: int) -> DataFrame:
    """nodes (tree, i, n, h) with the digests of their siblings to the left and right, joined in a row."""
    nothing = F.lit(b"")
    own = F.col("i") % arity
    if arity == 2:
        other = nodes.select("tree", F.col("i").bitwiseXOR(F.lit(1).cast("long")).alias("i"), F.col("h").alias("_s"))
        rows, found = nodes.join(other, ["tree", "i"], "left"), F.coalesce("_s", nothing)
        return rows.select("tree", "i", "n", "h", F.when(own == 1, found).otherwise(nothing).alias("left"), F.when(own == 0, found).otherwise(nothing).alias("right"))
    rows, found = nodes, []
    for step in range(1, arity):
        asks = F.col("i") - own + (own - step + arity) % arity
        other = nodes.select("tree", asks.alias("i"), F.struct(own.alias("slot"), "h").alias(f"_s{step}"))
        rows = rows.join(other, ["tree", "i"], "left")
        found.append(F.col(f"_s{step}"))
    others = F.array_sort(F.filter(F.array(*found), lambda s: s.isNotNull()))
    side = lambda keep: F.aggregate(F.filter(others, keep), nothing, lambda t, s: F.concat(t, s["h"]))
    return rows.select("tree", "i", "n", "h", side(lambda s: s["slot"] < own).alias("left"), side(lambda s: s["slot"] > own).alias("right"))


def climb(nodes: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """The levels below the roots, as tables, and tree, h, depth of each tree's root."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, roots = [], nodes.where("n = 1").select("tree", "h", F.lit(0).alias("depth"))
    while most > 1:
        level = written(paired(nodes.where("n > 1"), arity), "level")
        levels.append(level)
        up = level.where(F.col("i") % arity == 0)
        nodes = up.select("tree", F.floor(F.col("i") / arity).alias("i"), F.ceil(F.col("n") / arity).alias("n"), parent(F.col("left"), F.col("h"), F.col("right")).alias("h"))
        roots = roots.unionByName(nodes.where("n = 1").select("tree", "h", F.lit(len(levels)).alias("depth")))
        most = -(-most // arity)
    return levels, written(roots, "roots")


def descend(levels: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """tree, i, path and what else tops hold of each leaf.  tops: tree, depth, path (of the tree's root) and more."""
    kept = [c for c in tops.columns if c not in ("tree", "depth", "path")]
    at = lambda depth: tops.where(F.col("depth") == depth).select("tree", F.lit(0).cast("long").alias("i"), "path", *kept)
    above = at(len(levels))
    done: list[DataFrame] = []
    for k in reversed(range(len(levels))):
        own = levels[k].select("tree", "i", F.floor(F.col("i") / arity).alias("_up"), F.array(F.struct("left", "right")).alias("_own"))
        found = own.join(above.withColumnRenamed("i", "_up"), ["tree", "_up"])
        above = found.select("tree", "i", F.concat("_own", "path").alias("path"), *kept).unionByName(at(k))
        if k:
            above = written(above, "paths")
            discard(levels[k], *done)
            done = [above]
    return above


@dataclass(frozen=True)
class Manifest:
    """root: 32 bytes or None; leaves: group, order, leaf, other (a second digest, if asked for), subroot and path of each row."""

    root: bytes | None
    leaves: DataFrame


def manifest(df: DataFrame, columns: tuple[str, ...], group: str, order: str, arity: int = 2, other: dict[str, Column] | None = None) -> Manifest:
    """The manifest of df's rows by the named columns.

    other: columns to be put in the place of some for a second leaf, which is
    no part of the tree, as to see what a change does.
    """
    if arity < 2:
        raise ValueError(f"a parent has two children or more, not {arity}")
    leaf = digest(*[said(F.col(c)) for c in columns])
    changed = digest(*[said((other or {}).get(c, F.col(c))) for c in columns]) if other else leaf
    rows = df.select(F.col(group).alias("_group"), F.col(order).alias("_order"), said(F.col(group)).alias("_key"), leaf.alias("leaf"), changed.alias("other"))
    # Texts are read and hashed once; what follows is of a bounded width a row.
    rows = written(rows, "digests")
    placed = ordinals(rows, "_group", "_order", "leaf")
    # A tree is named by the first ordinal in it.
    trees = written(placed.groupBy("_key").agg(F.min("ordinal").alias("tree"), F.count("*").alias("n")), "trees")
    counts = trees.select("_key", F.col("n").alias("count"))
    size = trees.agg(F.sum(80 + F.octet_length("_key"))).first()[0] or 0
    in_trees = placed.join(F.broadcast(trees), "_key") if size <= BROADCAST_BYTES else join_unique(placed, trees, "_key", counts, F.col("ordinal"))
    leaves = written(in_trees.select("_group", "_order", "leaf", "other", "tree", (F.col("ordinal") - F.col("tree")).alias("i"), "n"), "leaves")
    discard(placed, rows)
    levels, roots = climb(leaves.select("tree", "i", "n", F.col("leaf").alias("h")), arity)

    # The groups' roots, in the groups' order, are the leaves of the last tree.
    ranked = ordinals(roots, "tree", name="i")
    n = roots.count()
    last = written(ranked.select(F.lit(-1).cast("long").alias("tree"), "i", F.lit(n).cast("long").alias("n"), "h", F.col("tree").alias("_of"), "depth"), "groups")
    top_levels, top = climb(last.select("tree", "i", "n", "h"), arity)
    first = top.first()
    start = top.select("tree", "depth", F.array().cast("array<struct<left: binary, right: binary>>").alias("path"))
    way = descend(top_levels, start, arity).select("i", "path")
    tops = written(last.join(way, "i").select(F.col("_of").alias("tree"), "depth", "path", F.col("h").alias("subroot")), "tops")
    found = leaves.select("_group", "_order", "leaf", "other", "tree", "i").join(descend(levels, tops, arity), ["tree", "i"])
    return Manifest(bytes(first["h"]) if first else None, found.select(F.col("_group").alias(group), F.col("_order").alias(order), "leaf", "other", "subroot", "path"))


def manifest_report(docs: DataFrame, arity: int = 2) -> DataFrame:
    """Each document's proof, and whether its leaf still leads to the root once every seventh (by its id's crc32) says one sign more."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    made = manifest(docs, LEAF, "lang", "doc_id", arity, {"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})
    root = F.lit(made.root.hex() if made.root else None).cast("string")
    fold = text(folded(F.col("other"), F.col("path")))
    shown = made.leaves.select("doc_id", text(F.col("leaf")).alias("leaf"), text(F.col("subroot")).alias("subroot"), root.alias("root"), F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"), fold.alias("folded_root"))
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_report(documents(spark, sf_dir))


SQL = """
    WITH RECURSIVE told AS (
        SELECT doc_id, lang, [doc_id::VARCHAR, source, lang, n_chars::VARCHAR, text] AS v, [doc_id::VARCHAR, source, lang, (n_chars + 1)::VARCHAR, text] AS more,
               list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                           lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda y, j: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)) AS c
        FROM documents
    ), hashed AS (
        SELECT doc_id, lang, sha256(array_to_string(list_transform(v, lambda x: CASE WHEN x IS NULL THEN '-' ELSE strlen(x) || ':' || x END), '')) AS leaf,
               sha256(array_to_string(list_transform(CASE WHEN xor(c, 4294967295) % 7 = 0 THEN more ELSE v END, lambda x: CASE WHEN x IS NULL THEN '-' ELSE strlen(x) || ':' || x END), '')) AS other
        FROM told
    ), leaves AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g
        FROM hashed
    ), nodes AS (
        SELECT g, 0 AS level, i, n, leaf AS h FROM leaves
        UNION ALL
        SELECT g, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY g, level, i // 2, n
    ), subs AS (SELECT g, h FROM nodes WHERE n = 1),
    tops AS (
        SELECT 0 AS level, g AS i, count(*) OVER () AS n, h FROM subs
        UNION ALL
        SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY level, i // 2, n
    ), low AS (
        SELECT doc_id, leaf, g, 0 AS level, i, n, '' AS proof, other AS f FROM leaves
        UNION ALL
        SELECT doc_id, leaf, u.g, u.level + 1, u.i // 2, (u.n + 1) // 2, proof || coalesce(s.h, ''), sha256(CASE WHEN u.i % 2 = 1 THEN s.h || f ELSE f || coalesce(s.h, '') END)
        FROM low u LEFT JOIN nodes s ON s.g = u.g AND s.level = u.level AND s.i = xor(u.i, 1) WHERE u.n > 1
    ), high AS (
        SELECT doc_id, leaf, g, 0 AS level, g AS i, (SELECT count(*) FROM subs) AS n, proof, f FROM low WHERE n = 1
        UNION ALL
        SELECT doc_id, leaf, u.g, u.level + 1, u.i // 2, (u.n + 1) // 2, proof || coalesce(s.h, ''), sha256(CASE WHEN u.i % 2 = 1 THEN s.h || f ELSE f || coalesce(s.h, '') END)
        FROM high u LEFT JOIN tops s ON s.level = u.level AND s.i = xor(u.i, 1) WHERE u.n > 1
    )
    SELECT doc_id, leaf, subs.h AS subroot, top.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = top.h AS verified
    FROM high JOIN subs USING (g) JOIN (SELECT h FROM tops WHERE n = 1) AS top ON high.n = 1
"""
