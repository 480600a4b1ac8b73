"""The pipeline against plain Python, from the first stage's decisions on."""

import random
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from memloom.llm import language_id
from memloom.llm.line_dedup import line_key
from test_joins import edited, shingle_set

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    path = str(tmp_path_factory.mktemp("sf"))
    sets = {"en": "the of and thing with that from other there".split(), "de": "der die und nicht schön über große einer".split()}
    say = lambda lang, n: " ".join(rng.choice(sets[lang]) + rng.choice(["", "en", "ing"]) + str(rng.randrange(30)) for _ in range(n))
    lines = [say("en", 12) for _ in range(4)] + ["short line"]
    items = [say("en", n) for n in (3, 8, 30)]
    texts = []
    for k in range(240):
        text = say("de" if k % 4 == 0 else "en", rng.choice([3, 30, 120]))
        if k % 5 == 0:
            text += "\n" + rng.choice(lines)
        if k % 17 == 0:
            text += " " + rng.choice(items)
        texts.append(text)
        if k % 6 == 0:
            texts.append(edited(rng, text, rng.randrange(3)))
    texts += [say("en", 30_000), say("de", 20_000) + "\n" + lines[0]]
    rows = [(k, t, "de" if "ü" in t else "en", "s", len(t)) for k, t in enumerate(texts)] + [(900, None, "en", "s", None), (901, "", "en", "s", 0), (902, "12 !", None, None, 4)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def after_language(rows, items):
    """doc_id to text, after the three filters that SQL could say."""
    found = defaultdict(set)
    for i, t in rows:
        for key in map(line_key, t.split("\n")):
            if len(key) >= 40:
                found[key].add(i)
    last = {k: max(v) for k, v in found.items() if len(v) >= 5}
    rows = [(i, "\n".join(x for x in t.split("\n") if last.get(line_key(x), i) == i)) for i, t in rows]
    sets, root = {i: shingle_set(t, 5) for i, t in rows}, {i: i for i, _ in rows}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in sets:
        for j in sets:
            common = len(sets[i] & sets[j])
            if j < i and common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    leaks = [shingle_set(t, 5) for t in items]
    return {i: t for i, t in rows if find(i) == i and not any(len(s & sets[i]) >= 0.8 * len(s) for s in leaks)}


def test_pipeline(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = corpus_pipeline.identified(spark, docs, path)
    assert kept.columns == docs.columns
    first = {r.doc_id: r.text for r in kept.collect()}
    assert not {900, 901, 902} & first.keys() and len(first) > 0.9 * len(rows)
    want = after_language(sorted(first.items()), items)
    assert len(want) < len(first) - 10
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    got = corpus_pipeline.run(spark, path).collect()
    assert sorted(r.doc_id for r in got) == sorted(want)
    for r in got:
        ids = library.encode(want[r.doc_id], add_special_tokens=False).ids
        assert memoryview(bytes(r.ids)).cast("I").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded == library.decode(ids, skip_special_tokens=False)


def test_stages(spark, folder):
    path, _, _ = folder
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    none = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, path).collect() == []
    docs = spark.createDataFrame([(1, None, None, None, None), (None, "a", "en", "s", 1), (None, "a", "en", "s", 1)], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns
    assert language_id.UNKNOWN == "und"


def test_columns_of_the_documents_own_stay(spark, folder):
    """Stages add columns under free names: like-named ones keep their values."""
    path, rows, _ = folder
    own = "score double, lang_pred string, n_lines long, n_dropped long, node long, n_shingles long, component_id long, item_id long, containment double"
    mine = (42.0, "mine", -7, -8, -9, -10, -11, -12, 0.5)
    docs = spark.createDataFrame([(*r, *mine) for r in rows[:120]], f"{SCHEMA}, {own}")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, path)
        assert got.columns == docs.columns, name
        kept = got.collect()
        assert kept and {tuple(r)[5:] for r in kept} == {mine}, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, path).count() == 120
