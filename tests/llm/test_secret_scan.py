import hashlib
import random
import re

from memloom.llm.secret_scan import BlobLedger, scan_documents, secret_report

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    line = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans))
    return tuple(sum(x[1] == k for x in spans) for k in range(3)) + (hashlib.sha256(line.encode()).hexdigest(), line)


def texts():
    rng = random.Random(3)
    bits = ["password", "PASSWD", "token", "api_key", "apikey", "secret", "=", ":", " ", '"', "'", "abcdefgh1", "short", "AKIA", "AKIA" + "Q" * 12,
            "AKIA" + "Z" * 11, "0123456789abcdef" * 2, "deadbeef", "é", "😀", "\n", "x" * 5, "token=secret=abcdefgh1", "token: api_key: abcdefgh12"]
    return [None, "", "a" * 200_000, *["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(300)]]


def test_equals_brute_force(spark, frame):
    rows = [(i, t) for i, t in enumerate(texts())] + [(7, "again token=abcdefgh1"), (7, "again token=abcdefgh1"), (None, "token=abcdefgh1")]
    got = secret_report(spark, frame(rows)).collect()
    want = sorted(((i is None, i or 0), *brute(t)) for i, t in rows)
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in got) == want


def test_scans_only_unseen_blobs(spark, frame):
    ledger = BlobLedger(spark)
    first = frame([(1, "token=abcdefgh1"), (2, "plain"), (3, "plain")])
    scan_documents(first, ledger)
    assert ledger.scanned("base-1").count() == 2
    second = frame([(1, "token=abcdefgh1"), (1, "secret: 12345678"), (9, "plain"), (8, "token=abcdefgh1")])
    got = scan_documents(second, ledger)
    assert sorted((r.doc_id, len(r.spans)) for r in got.collect()) == [(1, 1), (1, 1), (8, 1), (9, 0)]
    assert ledger.scanned("base-1").count() == 3
    assert spark.read.parquet(f"{ledger.path}/findings").count() == 2
    scan_documents(first, ledger, version="base-2")
    assert ledger.scanned("base-2").count() == 2


def test_empty_table(spark, frame):
    assert secret_report(spark, frame([])).collect() == []


def test_many_matches_are_linear(spark, frame):
    rows = [(1, "x token=abcdefgh1 é " * 40_000), (2, "AKIA" + "Q" * 16)]
    got = {r.doc_id: r for r in secret_report(spark, frame(rows)).collect()}
    for i, t in rows:
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex, got[i].base_sha256) == brute(t)[:4]
