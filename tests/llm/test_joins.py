import math
import random
import re

import numpy as np

from memloom.llm import ann_scan, decontaminate, jaccard_join, resample
from memloom.llm.components import connected_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def edited(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits if len(words) > edits else 0):
        at = rng.randrange(len(words))
        words[at : at + 1] = rng.choice([[], [f"new{rng.random()}"], [words[at], "more"]])
    return " ".join(words)


def corpus(seed=0):
    """Families of near copies around bases of all sizes, some joined only by chains, and passages that many rows share."""
    rng = random.Random(seed)
    out, word = [], lambda: f"w{rng.randrange(4000)}"
    hot = " ".join(word() for _ in range(60))
    for size in [3, 4, 5, 8, 9, 10, 11, 12, 14, 18, 25, 40, 70, 120, 300, 900]:
        base = " ".join(word() for _ in range(size))
        for _ in range(10):
            out.append(edited(rng, base, rng.randrange(0, 3 + size // 40)))
            base = rng.choice([base, out[-1]])
        out += [f"{base} {hot}", f"{' '.join(word() for _ in range(9))} {hot}", base.upper(), f"{hot} {word()}"]
    return out


def linked(rows, words, percent):
    sets = [shingle_set(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b)
            if a and b and 100 * common >= percent * (len(a) + len(b) - common):
                root[find(i)] = find(j)
    low = -(2**63)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), 2**63), low if i is None else i)
    return sorted((str(i), len(sets[k]), str(None if least[find(k)] == low else least[find(k)])) for k, (i, _) in enumerate(rows))


def test_groups_equal_brute_force(frame):
    rows = list(enumerate(corpus())) + [(900, None), (901, ""), (902, " \t"), (5, corpus()[5]), (5, corpus()[40]), (None, corpus()[7]), (903, "a b"), (904, "A  b")]
    for words, percent in ((4, 85), (5, 80)):
        got = jaccard_join.linked_groups(frame(rows), words, percent).collect()
        assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == linked(rows, words, percent)


def test_keep_one(frame):
    rows = list(enumerate(corpus(1)))
    want = {int(i) for i, _, c in linked(rows, 5, 80) if i == c}
    kept = jaccard_join.keep_one(frame(rows))
    assert {r.doc_id for r in kept.collect()} == want
    assert "node" in kept.columns
    assert jaccard_join.linked_groups(frame([])).collect() == []


def test_linking_sets_share_a_signature():
    """The pigeonhole, with every allocation that the cost model can choose."""
    rng = np.random.default_rng(0)
    for sets in (1, 10**4, 10**9, 10**14):
        signer = jaccard_join.Signer(85, sets)
        for _ in range(400):
            n = int(rng.choice([7, 8, 9, 12, 13, 20, 40, 90, 200, 500, 520, 1030, 1100]))
            a = np.unique(rng.integers(0, 2**63, n).astype("u8"))
            most = jaccard_join.largest_difference(n, 85)
            drop = int(rng.integers(0, most + 1))
            b = np.unique(np.r_[a[drop:], rng.integers(0, 2**63, int(rng.integers(0, most - drop + 1))).astype("u8")])
            common = len(np.intersect1d(a, b))
            if len(b) and 100 * common >= 85 * (len(a) + len(b) - common) and len(a) != common:
                assert len(np.intersect1d(signer.of(a), signer.of(b)))
                differ = jaccard_join.differing_bits(jaccard_join.sketch(a), jaccard_join.sketch(b))
                assert jaccard_join.may_link(np.array(len(a)), np.array(len(b)), differ, 85)


def test_linking_sets_across_the_last_band():
    """Each side has a signer of its own, as in tasks that saw no longer text."""
    rng = np.random.default_rng(1)
    for percent in (85, 80, 50):
        first = jaccard_join.Signer(percent, 10**4).bands[-1].high
        for high in (first, jaccard_join.bands_up_to(2 * (first + 1), percent, 10**4)[-1].high):
            for n in (high, percent * (high + 1) // 100 + 1):
                a = np.unique(rng.integers(0, 2**63, n).astype("u8"))
                b = np.union1d(a, rng.integers(0, 2**63, high + 1 - len(a)).astype("u8"))
                assert len(a) <= high < len(b) and 100 * len(a) >= percent * len(b)
                x, y = (jaccard_join.Signer(percent, 10**4) for _ in "ab")
                alone = x.of(a)
                assert len(np.intersect1d(alone, y.of(b)))
                x.of(np.unique(rng.integers(0, 2**63, 4 * n).astype("u8")))
                assert np.array_equal(x.of(a), alone)


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 101), (103, 101), (102, 103), (7, 7)]
    got = connected_components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 104)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_contaminations_equal_brute_force(spark, frame):
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(300)}"
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([1, 3, 4, 5, 6, 9, 20, 21, 35, 60, 130, 400] * 3)]
    items += [(100, None), (101, ""), (102, items[5][1]), (None, items[6][1]), (5, items[5][1])]
    docs = []
    for k in range(200):
        body = [word() for _ in range(rng.choice([0, 3, 50, 400, 3000]))]
        for _ in range(rng.randrange(3)):
            text = rng.choice(items)[1] or ""
            at = rng.randrange(len(body) + 1)
            body[at:at] = edited(rng, text, rng.randrange(3)).split(" ")
        docs.append((k, " ".join(body).title()))
    docs += [(300, None), (None, items[6][1]), (7, docs[7][1])]
    table = spark.createDataFrame(items, "item_id long, text string")
    want, hit = [], set()
    for at, (d, text) in enumerate(docs):
        own = shingle_set(text, 5)
        for i, item in items:
            s = shingle_set(item, 5)
            if s and len(s & own) >= 0.8 * len(s) - 1e-9:
                want.append((str(d), str(i), len(s), len(s & own)))
                hit.add(at)
    for size in (16 << 20, 6_000):
        got = decontaminate.contaminations(frame(docs), table, block_bytes=size).collect()
        assert sorted((str(r.doc_id), str(r.item_id), r.n_shingles, r.n_common) for r in got) == sorted(want)
        assert all(math.isclose(r.containment, r.n_common / r.n_shingles) for r in got)
        left = decontaminate.decontaminate(frame(docs), table, block_bytes=size)
        assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(d) for k, (d, _) in enumerate(docs) if k not in hit)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminations(frame(docs), none).collect() == []
    assert decontaminate.decontaminate(frame(docs), none).count() == len(docs)
    assert decontaminate.contaminations(frame([]), table).collect() == []


def test_items_in_long_texts_are_found(spark, frame):
    rng = random.Random(12)
    say = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    items = [(1, say(6)), (2, say(40)), (3, say(300)), (4, say(20))]
    body = [say(30_000), items[0][1], say(30_000), items[1][1], say(100), items[2][1], say(30_000)]
    table = spark.createDataFrame(items, "item_id long, text string")
    docs = frame([(1, " ".join(body)), (2, say(90_000))])
    got = decontaminate.contaminations(docs, table).collect()
    assert sorted((r.doc_id, r.item_id, r.containment) for r in got) == [(1, k, 1.0) for k in (1, 2, 3)]
    assert [r.doc_id for r in decontaminate.decontaminate(docs, table).collect()] == [2]


def cosine_top(rows, queries, k=5):
    out = {}
    for q in queries:
        for v in {tuple(x) for i, x in rows if i == q}:
            score = {i: float(np.dot(v, x) / (np.linalg.norm(v) * np.linalg.norm(x))) for i, x in rows if i != q}
            out[q] = sorted(score.items(), key=lambda s: (-round(s[1], 12), s[0]))[:k]
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = [(k, (centres[k % 12] + 0.4 * rng.normal(size=16)).astype("f4").tolist()) for k in range(3000)]
    rows += [(k, rows[50][1]) for k in range(3000, 3400)]
    odd = [(4000, None), (4050, [0.0] * 16), (4001, [None] * 16), (4002, [float("nan")] * 16), (4003, [float("inf")] * 16), (4004, [1.0]), (None, rows[1][1])]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows + odd + rows[:3]], "vec_id long, embedding array<float>, score int")
    got = {}
    for r in ann_scan.neighbour_report(table).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = cosine_top(rows, range(0, 3400, 50))
    assert got.keys() == want.keys()
    hits = 0
    for q, top in want.items():
        own = sorted(got[q])
        assert [x[0] for x in own] == [1, 2, 3, 4, 5]
        hits += len({x[1] for x in own} & {i for i, _ in top})
    assert hits >= 0.9 * 5 * len(want)
    assert [x[1] for x in sorted(got[50])] == [3000, 3001, 3002, 3003, 3004]
    assert [x[1] for x in sorted(got[3000])] == [50, 3001, 3002, 3003, 3004]


def test_few_neighbours(spark):
    schema = "vec_id long, embedding array<float>"
    got = ann_scan.neighbour_report(spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [2.0, 2.0])], schema)).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in sorted(got)] == [(0, 1, 1), (0, 2, 2)]
    assert math.isclose(got[0].score, 0.5**0.5)
    assert ann_scan.neighbour_report(spark.createDataFrame([], schema)).collect() == []


def test_resample(spark, frame):
    rng = random.Random(4)
    good, bad = "the of and in that with from this".split(), "buy!! now!! free$$ click## win** cash&&".split()
    rows = [(k, " ".join(rng.choice(good if k % 2 else bad) for _ in range(40))) for k in range(400)] + [(500, None), (501, ""), (3, rows_text := "the of"), (None, rows_text)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(0, 400, 3)] + [(9999, 1), (1, None)], "doc_id long, quality int")
    got = resample.quality_report(frame(rows), labels).collect()
    assert len(got) == len(rows) and sum(r.selected for r in got) == len(rows) // 2
    held = [(r.weight > 0, r.doc_id % 2 == 1) for r in got if r.held_out and r.doc_id < 400]
    assert np.mean([a == b for a, b in held]) > 0.97
    last = min(r.key for r in got if r.selected)
    assert all(r.key <= last for r in got if not r.selected)
    assert {r.weight for r in got if r.doc_id in (500, 501)} == {0.0}
    assert resample.quality_report(frame([]), labels).collect() == []


def test_kth_largest(spark):
    rng = np.random.default_rng(6)
    keys = np.r_[rng.normal(size=3000), np.zeros(500), [1e6, -1e6]]
    rows = sorted(((float(x), k) for k, x in enumerate(keys)), key=lambda r: (-r[0], r[1]))
    table = spark.createDataFrame([(k, float(x)) for k, x in enumerate(keys)], "doc_id long, key double")
    for k in (1, 2, 1700, 3502):
        assert resample.kth_largest(table, k, enough=50, cells=16) == (rows[k - 1][0], rows[k - 1][1])


def test_keep_one_decides_by_set(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text, 0), (2, text + " more", 0), (2, "quite another text of its own that nobody else has", 0), (3, None, 0), (3, None, 0), (None, text + " less", 0), (4, text, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone_id int")
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["2", "3", "3", "None"]
    assert [r.text for r in kept.collect() if r.doc_id == 2] == [rows[2][1]]


def test_blocks_of_a_signature_give_the_same(spark, frame):
    docs = frame(list(enumerate(corpus(3))))
    every = jaccard_join.signed_sets(docs, 4, 85, 300).cache()
    shared = jaccard_join.shared_signatures(every, 3).cache()
    nodes = every.where("node is not null").dropDuplicates(["node"]).select("node", "id", "n", "sketch").cache()
    none = spark.createDataFrame([], "a long, b long")
    apart = spark.createDataFrame([], "node long, root long")
    found = [sorted(jaccard_join.open_pairs(shared, apart, none, nodes, 85, size).collect()) for size in (1 << 20, 600)]
    assert found[0] == found[1] and len(found[0]) > 20


def test_sketches_go_to_a_task_once(spark, frame):
    """All nodes of a signature meet in a task, or each two in one of its blocks; a node's row is not copied for each signature."""
    rng = np.random.default_rng(11)
    nodes = spark.createDataFrame([(k, 90, [k] * 16) for k in range(60)], "node long, n long, sketch array<long>")
    held = {s: rng.choice(60, 2 + s % 7, replace=False).tolist() for s in range(300)} | {300: list(range(60))}
    placed = spark.createDataFrame([(s, n, n) for s, ns in held.items() for n in ns], "signature long, node long, root long")
    apart = spark.createDataFrame([(s, len(ns), 192 * len(ns), min(ns)) for s, ns in held.items()], "signature long, count long, size long, least long")
    for size in (1 << 20, 192 * 40, 192 * 8):
        rows = jaccard_join.dealt(placed, apart, nodes, size).collect()
        tasks, met = {}, {s: set() for s in held}
        for r in rows:
            assert r.sketch == [r.node] * 16 and r.root == r.node
            tasks.setdefault(r.task, []).append(r)
        for in_task in tasks.values():
            assert len({r.node for r in in_task}) == len(in_task)
            for x in in_task:
                for y in in_task:
                    for s in {(h.signature, h.side) for h in x.held}:
                        met[s[0]] |= {(x.node, y.node) for h in y.held if x.node < y.node and h.signature == s[0] and (h.side == 0 or h.side != s[1])}
        assert met == {s: {(x, y) for x in ns for y in ns if x < y} for s, ns in held.items()}
        assert size < 1 << 20 or len(rows) == 60


def test_sketches_of_one_bit_a_shingle_part_unrelated_sets():
    rng = np.random.default_rng(12)
    for n in (1024, 4096, 8192):
        a, b = (np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for _ in "ab")
        assert 64 * len(jaccard_join.sketch(a)) == n
        assert not jaccard_join.may_link(np.array(n), np.array(n), jaccard_join.differing_bits(jaccard_join.sketch(a), jaccard_join.sketch(b)), 80)


def test_long_texts_link(frame):
    rng = random.Random(5)
    words = [f"w{rng.randrange(50_000)}" for _ in range(60_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[1_000:])), (3, " ".join(words[30_000:])), (4, "short text of no account")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.linked_groups(frame(rows)).collect()}
    assert {k: c for k, (_, c) in got.items()} == {1: 1, 2: 1, 3: 3, 4: 4}
    assert got[1][0] == len(shingle_set(rows[0][1], 4))


def test_hot_keys_are_dealt(spark):
    from memloom.llm.common import join_unique, written

    many = written(spark.createDataFrame([(k % 7 and 1, k) for k in range(5000)], "key long, x long"), "many")
    one = spark.createDataFrame([(k, f"v{k}") for k in range(3)], "key long, v string")
    got = join_unique(many, one, "key", many.groupBy("key").count(), most=100)
    assert sorted(map(tuple, got.collect())) == sorted((k % 7 and 1, k, f"v{k % 7 and 1}") for k in range(5000))


def test_weights_equal_counts(spark, frame):
    """The log ratio of both models' likelihoods, by plain counts of the same buckets."""
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choice(["good", "fine"] if k % 2 else ["bad", "poor"]) + str(rng.randrange(5)) for _ in range(12))) for k in range(60)] + [(70, None), (71, "good1 " * 30_000)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int")
    o = resample.Options(bits=8)
    size = 1 << o.bits
    counts = lambda texts: sum((np.bincount(resample.buckets(t, o.bits), minlength=size) for t in texts), np.zeros(size))
    held = {r.doc_id for r in resample.quality_report(frame(rows), labels).where("held_out").collect()}
    raw, target = counts(t for _, t in rows), counts(t for k, t in rows if k < 60 and k % 2 and k not in held)
    share = (raw + o.prior) / (raw.sum() + o.prior * size)
    ratio = np.log((target + o.back_off * share) / (target.sum() + o.back_off) / share)
    model = resample.fit(frame(rows), labels, "quality", o)
    got = {r.doc_id: r.weight for r in resample.weigh(frame(rows), model, o).collect()}
    for k, t in rows:
        assert math.isclose(got[k], sum(ratio[b] for b in resample.buckets(t, o.bits).tolist()), rel_tol=1e-9, abs_tol=1e-9)


def test_ties_of_one_key(spark):
    rows = spark.createDataFrame([(k % 3000, 1.5) for k in range(6000)] + [(None, 1.5)] * 5, "doc_id long, key double")
    assert resample.kth_largest(rows, 4001, enough=10) == (1.5, 2000)
    assert resample.kth_largest(rows, 6003, enough=10) == (1.5, None)
