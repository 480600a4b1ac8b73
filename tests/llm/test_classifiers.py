import zlib

import numpy as np
import pytest

from memloom.llm import language_id, resample, toxicity

RNG = np.random.default_rng(0)
SETS = {"en": "the of and thing with that from", "de": "der die und nicht schön über große", "fr": "le les été où français très à"}


def sentence(words, n):
    return " ".join(RNG.choice(words.split(), n))


@pytest.fixture(scope="module")
def told(frame):
    rows = [(k, sentence(SETS[lang], 5 + k % 40), lang) for k, lang in ((k, list(SETS)[k % 3]) for k in range(400))]
    return rows + [(1000, None, "en"), (1001, "", "de"), (1002, "123 !?", "fr"), (1003, "the of and", None), (None, "und nicht", "de"), (7, "le les", "fr"), (1004, "the of " * 20_000, "en")]


def test_language_id(spark, frame, told):
    got = language_id.language_report(frame(told)).collect()
    assert len(got) == len(told)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for k in (1000, 1001, 1002):
        assert (by[k][0].lang_pred, by[k][0].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in got)
    known = [(r.lang_pred, lang) for k, t, lang in told if k is not None and k < 400 and k != 7 for r in by[k] if r.held_out]
    assert np.mean([a == b for a, b in known]) > 0.95
    assert by[5][0].held_out == (zlib.crc32(b"5") % 3 == 1) and not by[None][0].held_out
    assert len(by[7]) == 2


def test_language_id_without_languages(spark, frame):
    got = language_id.language_report(frame([(1, "text", None)])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
    assert language_id.language_report(frame([])).collect() == []


def test_tables_equal_the_convolution():
    net = language_id.ByteNet(["a", "b"], language_id.Options(window=16))
    x = RNG.integers(0, 256, (5, 19)).astype(np.uint8)
    e, parts = net.w["e"][x], []
    for k in language_id.WIDTHS:
        f = net.w[f"f{k}"].reshape(k, net.o.dim, -1)
        parts.append(sum(e[:, j : j + 16] @ f[j] for j in range(k)).max(1) + net.w[f"b{k}"])
    z = np.maximum(np.concatenate(parts, 1), 0) @ net.w["s"] + net.w["t"]
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    assert np.allclose(net.predict(x, net.tables()), p, atol=1e-5)


def test_toxicity(spark, frame):
    rows, labels = [], []
    for k in range(1500):
        toxic = k % 5 == 0
        words = sentence(SETS["en"], 30).split()
        if toxic:
            words.insert(int(RNG.integers(30)), "Vile.")
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    rows += [(5000, None), (5001, ""), (0, rows[0][1]), (None, "vile"), (5002, "the " * 50_000)]
    labels += [(9999, 1), (3, None), (None, 1)]
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxicity_report(frame(rows), table).collect()
    assert len(got) == len(rows)
    score = {r.doc_id: r for r in got}
    held = [(r.predicted, r.doc_id % 5 == 0) for r in got if r.held_out and r.doc_id < 1500]
    assert np.mean([a == b for a, b in held]) > 0.99
    assert score[5000].score == score[5001].score < 0.7
    assert all(r.predicted == int(r.score >= 0.7) for r in got)


@pytest.mark.parametrize("shard_rows", [400, 10_000])
def test_words_of_few_toxic_rows(spark, frame, shard_rows):
    """Words that six toxic rows hold are learnt with as many shards as with one."""
    rng = np.random.default_rng(2)
    fill = lambda: [f"word{k}" for k in rng.integers(0, 400, 12)]
    ids = [k for k in range(3000) if zlib.crc32(str(k).encode()) % 3 != 1][:1600]
    toxic = {int(i): f"vile{at % 40}" for at, i in enumerate(rng.permutation(ids)[:240])}
    rows = [(i, " ".join([*fill(), *([toxic[i]] if i in toxic else []), *fill()])) for i in ids]
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in ids], "doc_id long, toxic int")
    o = toxicity.Options(shard_rows=shard_rows)
    model = toxicity.fit(frame(rows), labels, "toxic", o)
    told = toxicity.score(frame([(k, f"vile{k}") for k in range(40)] + [(k, " ".join(fill())) for k in range(40, 140)]), model, options=o).collect()
    assert np.mean([r.predicted for r in told if r.doc_id < 40]) > 0.9
    assert np.mean([r.predicted for r in told if r.doc_id >= 40]) < 0.05


def test_toxicity_sample_is_bounded(spark, frame, monkeypatch):
    """An id on many rows, or with many labels, is one row of the sample."""
    rows = [(2, f"text {k % 7}") for k in range(3000)] + [(k, f"word{k}") for k in range(100, 160)]
    labels = spark.createDataFrame([(2, 1), (2, 0), (2, 1)] * 20 + [(k, 0) for k in range(100, 160)], "doc_id long, toxic int")
    sizes = []
    monkeypatch.setattr(toxicity, "written", lambda df, tag: sizes.append(df.count()) or df)
    for most in (10, 16_000):
        toxicity.fit(frame(rows), labels, "toxic", toxicity.Options(max_rows=most))
    usable = [k for k in (2, *range(100, 160)) if zlib.crc32(str(k).encode()) % 3 != 1]
    assert sizes[0] <= 10 and sizes[1] == len(usable)


def test_toxicity_features_and_scores_equal_plain(spark, frame):
    """Distinct words, pairs and pairs that skip a word; a score is the logistic of their weights' sum."""
    one = lambda text: set(toxicity.features(text, 30).tolist()) - {0}
    for text in ("a", "a b", "a b c", "a b a b c a", "It is. It was, it IS!", "x " * 50, "é ü z"):
        words = text.lower().translate(str.maketrans("", "", ".,!")).split()
        plain = {(w,) for w in words} | {(1, *p) for p in zip(words, words[1:])} | {(2, *p) for p in zip(words, words[2:])}
        assert len(one(text)) == len(plain)
    assert one("a b c") > one("a b") > one("a") and one("a b c") & one("a x c") == (one("a") | one("c")) | (one("a b c") - one("a b") - one("b c") - one("c") - one("a"))
    assert one(None) == one("") == set()
    model = {"at": np.array([0, *sorted(one("vile thing"))[:2]], np.int32), "w": np.array([-1.0, 2.5, 0.25])}
    texts = ["vile thing", "thing", "", None, "vile vile thing " * 9]
    # The same buckets with fewer bits: their leading ones.
    model["at"] = (model["at"] >> 10).astype(np.int32)
    weights = dict(zip(model["at"].tolist(), model["w"].tolist()))
    got = toxicity.score(frame(list(enumerate(texts))), model).collect()
    for r in got:
        total = sum(weights.get(int(b), 0.0) for b in toxicity.features(texts[r.doc_id], 20))
        assert r.score == pytest.approx(1 / (1 + np.exp(-total))) and r.predicted == int(r.score >= 0.7)


def test_toxicity_without_labels(spark, frame):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.toxicity_report(frame([(1, "a b"), (2, None)]), none).collect()
    assert [r.score for r in got] == [0.5, 0.5]
    assert toxicity.toxicity_report(frame([]), none).collect() == []


def test_ftrl_equals_a_plain_loop():
    o, rng = toxicity.Options(bits=6, epochs=2, l1=0.3, alpha=0.5, l2=0.1), np.random.default_rng(4)
    rows = [np.unique(np.r_[0, rng.integers(1, 64, 8)]) for _ in range(60)]
    y = rng.integers(0, 2, 60)
    z, n = np.zeros(64), np.zeros(64)
    toxicity.ftrl(rows, y, z, n, o)
    pz, pn = [0.0] * 64, [0.0] * 64

    def weight(k):
        l1 = 0.0 if k == 0 else o.l1
        if abs(pz[k]) <= l1:
            return 0.0
        return -(pz[k] - (l1 if pz[k] > 0 else -l1)) / ((o.beta + pn[k] ** 0.5) / o.alpha + o.l2)

    for _ in range(o.epochs):
        for at, label in zip(rows, y):
            w = {k: weight(k) for k in at.tolist()}
            g = 1 / (1 + np.exp(-sum(w.values()))) - label
            for k in w:
                pz[k] += g - ((pn[k] + g * g) ** 0.5 - pn[k] ** 0.5) / o.alpha * w[k]
                pn[k] += g * g
    assert np.allclose(z, pz) and np.allclose(n, pn)
    assert (toxicity.weights_of(z, n, np.arange(64), o) == 0).any()


def test_gradients_equal_differences():
    o = language_id.Options(window=16, dim=3, filters=2)
    net = language_id.ByteNet(["a", "b", "c"], o)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x, y = np.random.default_rng(1).integers(97, 105, (4, 19)).astype(np.uint8), np.array([0, 2, 1, 2])

    def loss():
        e, parts = net.w["e"][x], []
        for k in language_id.WIDTHS:
            f = net.w[f"f{k}"].reshape(k, o.dim, -1)
            parts.append((sum(e[:, j : j + 16] @ f[j] for j in range(k)) + net.w[f"b{k}"]).max(1))
        s = np.maximum(np.concatenate(parts, 1), 0) @ net.w["s"] + net.w["t"]
        return (np.log(np.exp(s).sum(1)) - s[np.arange(4), y]).mean()

    for name, g in net.gradients(x, y).items():
        w = net.w[name].reshape(-1)
        for k in np.random.default_rng(2).integers(0, len(w), 12).tolist() if name != "e" else (97 * 3, 100 * 3 + 1, 104 * 3 + 2):
            w[k] += 1e-6
            up = loss()
            w[k] -= 2e-6
            assert abs((up - loss()) / 2e-6 - g.reshape(-1)[k]) < 1e-5
            w[k] += 1e-6


def test_columns_may_clash(spark):
    rows = [(k, "vile words" if k % 2 else "kind words", 1, 2, 3, 4) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id int, y int, id int, good_id int")
    labels = spark.createDataFrame([(k, k % 2, k % 2, 5) for k in range(40)], "doc_id long, toxic int, quality int, _id int")
    assert toxicity.toxicity_report(docs, labels).count() == 40
    assert resample.quality_report(docs, labels).count() == 40


def test_every_language_is_learned(spark, frame):
    rows = [(k, f"{chr(97 + k % 26) * 3}{chr(97 + k % 9) * 2} " * 20, f"l{k % 230}") for k in range(1400)]
    net = language_id.fit(frame(rows), language_id.Options(epochs=1, max_rows=460))
    taught = {lang for k, _, lang in rows if zlib.crc32(str(k).encode()) % 3 != 1}
    assert len(net.languages) > 0.7 * len(taught)
    assert language_id.fit(frame(rows), language_id.Options(epochs=1)).languages == sorted(taught)
