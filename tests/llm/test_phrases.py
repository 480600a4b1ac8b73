"""Collocations against plain counting, and against SQL."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from memloom.llm import phrases, queries

SCHEMA = "doc_id long, text string, lang string, phrase int, k string, n int, block string, shard int"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def plain(rows, least, longest, most):
    """rows: text, lang."""
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text or "")):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    known = {p: n for p, n in f.items() if n >= least}
    covered = {(lang, w[i : i + j]) for (lang, w), n in known.items() for j in range(2, len(w)) for i in range(len(w) - j + 1) if n >= known[lang, w[i : i + j]]}
    best = {}
    for (lang, w), a in known.items():
        if len(w) > 1 and (lang, w) not in covered:
            cuts = [(1000 * a * total[lang] // (f[lang, w[:c]] * f[lang, w[c:]]), c) for c in range(1, len(w))]
            score, c = min(cuts)
            best.setdefault(lang, []).append((" ".join(w), a, f[lang, w[:c]], f[lang, w[c:]], total[lang], score))
    out = []
    for lang, found in best.items():
        found.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, k + 1, *x) for k, x in enumerate(found[:most])]
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def corpus(seed, n):
    rng = random.Random(seed)
    words = "a A b the The of é naïve x-y 12   \x1f tail".split(" ") + ["w" * 300]
    out = []
    for k in range(n):
        said = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", " , ", "\n", "\r\n", ";", "!?"]) for _ in range(rng.randrange(0, 60)))
        out.append((said + "one two three four five six", "en" if k % 3 else rng.choice(["de", "", None])))
    out += [(None, "en"), ("", "en"), (" \t.\n", "fr"), ("und also " * 5, "und"), ("the of " * 3000, "en"), ("x" * 5000 + " the of a", "de")]
    return out + out[:5]


@pytest.mark.parametrize("shards,block,bits,longest", [(3, 200, 16, 5), (1, 1 << 20, 16, 5), (4, 64, 3, 4), (2, 1000, 10, 3), (4, 128, 6, 5)])
def test_collocations_equal_plain(spark, shards, block, bits, longest):
    """Few marks to share, small blocks and one shard only change what is counted in vain."""
    rows = corpus(shards, 120)
    docs = spark.createDataFrame([(k, *r, 1, "x", 2, "y", 3) for k, r in enumerate(rows)], SCHEMA).repartition(5)
    o = phrases.Mining(least=6, longest=longest, shards=shards, slot_bits=bits, block=block)
    assert got(phrases.collocations(docs, o, most=40, parts=3)) == plain(rows, 6, longest, 40)


def test_shared_marks_lose_no_count():
    """Bytes that many phrases share are marked early; a phrase is still counted in each shard once."""
    rng = np.random.default_rng(5)
    for bits in (2, 4, 5, 6, 7, 8):
        o = phrases.Mining(least=6, shards=4, slot_bits=bits)
        words = [f"w{k}" for k in range(40)]
        blocks = [" ".join(words[int(k)] for k in rng.zipf(1.3, 400) % 40) + "\n" + "a b c d e f " * int(rng.integers(0, 3)) for _ in range(16)]
        held = [phrases.normalised(np.frombuffer(b.encode(), np.uint8)) for b in blocks]
        marks, counts, about, scan, last = np.zeros(1 << bits, np.uint8), Counter(), {}, 0, -1
        while scan <= last + o.shards:
            for b in held[scan % 4 :: 4]:
                for k, found, _, slots, n in phrases.count_block(b, 0, 11, marks, scan, o):
                    for p, s, m in zip(found.to_pylist(), slots.tolist(), n.tolist()):
                        counts[p] += m
                        about[p] = (k, s)
            new = {s for p, (k, s) in about.items() if k < 5 and counts[p] >= 6 and not marks[s]}
            if new:
                marks[list(new)], last = scan + 1, scan
            scan += 1
        want = Counter(" ".join(w[i : i + k]) for b in held for piece in bytes(b).decode().split("\n") for w in [piece.split(" ")] for k in range(1, 6) for i in range(len(w) - k + 1))
        assert {p: n for p, n in counts.items() if n >= 6} == {p: n for p, n in want.items() if n >= 6}


def test_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_blocks_lose_no_phrase():
    """Every place of a phrase is in one block, before its context."""
    rng = random.Random(2)
    text = "".join(rng.choice(["ab", "c", "dddddd"]) + rng.choice([" ", " ", " ", "\n"]) for _ in range(500)) + "e" * 90 + " f g h i j"
    whole = phrases.normalised(np.frombuffer(text.encode(), np.uint8))
    grams = lambda words, own: Counter(tuple(words[i : i + k]) for k in range(1, 6) for i in range(own) if i + k <= len(words) and "\n" not in "".join(words[i : i + k]))
    for size in (1, 7, 40, 10**6):
        found = Counter()
        for block, context in phrases.cut(whole, size, 5):
            pieces = bytes(block).decode().split("\n")
            for p, piece in enumerate(pieces):
                words = piece.split(" ")
                found += grams(words, len(words) - (context if p == len(pieces) - 1 else 0))
        want = Counter()
        for piece in bytes(whole).decode().split("\n"):
            want += grams(piece.split(" "), len(piece.split(" ")))
        assert found == want


def test_hashes_that_lie_are_noticed():
    ids, at = np.array([1, 2, 1, 2, 3]), np.array([0, 1, 2, 3])
    first, n = phrases.distinct(ids, at, np.zeros(4, np.uint64), 2)
    assert sorted(zip([tuple(ids[at[f] : at[f] + 2]) for f in first], n)) == [((1, 2), 2), ((2, 1), 1), ((2, 3), 1)]


def test_distinct_phrases_come_in_the_order_of_the_text():
    """By a hash table instead of a sort, so that their texts are then read from front to back."""
    h = np.random.default_rng(3).integers(0, 2**64, 50, dtype=np.uint64)[np.random.default_rng(4).integers(0, 50, 400)]
    first, n = phrases.distinct(h, np.arange(400), h, 1)
    places = {}
    for k, x in enumerate(h.tolist()):
        places.setdefault(x, []).append(k)
    assert first.tolist() == [p[0] for p in places.values()] and n.tolist() == [len(p) for p in places.values()]


def test_scores_beyond_64_bits(spark):
    rows = [(2**40, 2**44, 2**41, 2**40), (10**12, 10**14, 10**12, 10**12), (100, 2**45, 100, 100), (7, 11, 8, 9)]
    table = spark.createDataFrame(rows, "a long, n long, l long, r long")
    assert [r.s for r in table.select(phrases.score("a", "n", "l", "r").alias("s")).collect()] == [1000 * a * n // (x * y) for a, n, x, y in rows]


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = duckdb.sql(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({queries.ORACLE_SQL['op13_phrase_collocations']})").fetchall()
    assert got(queries.QUERIES["op13_phrase_collocations"](spark, sf)) == sorted(want) and want
