import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from memloom.llm import line_dedup
from memloom.llm.line_dedup import PerfectHash, dedup_lines, line_key, line_report

LOW = -(2**63)


def brute(rows, least=40, docs=5):
    found = defaultdict(list)
    for i, t in rows:
        for key in {line_key(x) for x in (t or "").split("\n")}:
            if len(key) >= least:
                found[key].append(LOW if i is None else i)
    last = {k: max(v) for k, v in found.items() if len(v) >= docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if last.get(line_key(x), LOW if i is None else i) == (LOW if i is None else i)]
        out.append((str(i), len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def rows():
    rng = random.Random(1)
    common = [f"Shared LINE number {k} with enough É characters to count" for k in range(30)] + ["short one", "é" * 39, "é" * 40, "k" * 90_000]
    out = [(i, "\n".join(rng.choice(["", "  ", "\t"]) + rng.choice(common) + rng.choice(["", " \r"]) for _ in range(rng.randint(0, 9)))) for i in range(200)]
    return out + [(50, out[51][1]), (50, out[50][1]), (None, out[3][1]), (None, None), (500, ""), (501, None), (502, "\n\n")]


def result(df):
    return sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in df.collect())


def test_equals_brute_force(frame):
    assert result(line_report(frame(rows()))) == brute(rows())


@pytest.mark.parametrize("lines", [1, 7, 25])
def test_routed_probes_give_the_same(frame, lines):
    assert result(line_report(frame(rows()), array_bytes=24 * lines)) == brute(rows())


def test_routed_groups_are_bounded(frame, monkeypatch):
    """One shard, one very common id, and many lines that only one row has."""
    grouped = PandasCogroupedOps.applyInArrow

    def watched(self, answer, schema):
        def checked(own, probes):
            assert probes.num_rows <= 200
            return answer(own, probes)

        return grouped(self, checked, schema)

    monkeypatch.setattr(PandasCogroupedOps, "applyInArrow", watched)
    monkeypatch.setattr(line_dedup, "PROBE_ROWS", 100, raising=False)
    single = [(1000 + i, "\n".join(f"line {i} {k} that no other row of the table has at all" for k in range(20))) for i in range(60)]
    many = rows() + single + [(None, rows()[3][1] + "\n" + rows()[7][1])] * 40
    assert result(line_report(frame(many), array_bytes=24)) == brute(many)


def test_columns_stay(frame):
    with pytest.raises(ValueError, match="n_lines"):
        dedup_lines(frame(rows()))
    got = dedup_lines(frame(rows()), n_lines="before", n_dropped="gone")
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "spans", "n_lines", "score", "node", "before", "gone"]
    assert {(r.n_lines, r.node) for r in got.collect()} == {(8, 9)}


def test_empty_table(frame):
    assert line_report(frame([])).collect() == []


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(0).integers(0, 2**63, 5000).astype("u8")
    keys = np.unique(keys)
    assert sorted(PerfectHash(keys).find(keys)) == list(range(len(keys)))
    assert PerfectHash(keys[:0]).find(keys).max() == -1
